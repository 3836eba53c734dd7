"""DuckDB oracle SQL for every SQL-expressible registered query.

Each statement sees only the driver's raw tables as views, so the fixture logs
(click_log, basket_log, item_props, factor tables) are inlined as CTEs with the same
definitions as ``rankloom.sources.fixtures``.  Doubles are rounded to 6 digits on
both sides.
"""

from __future__ import annotations

CLICK_LOG = """click_log AS (
  SELECT epoch_us(ts) // 1000 AS "timestamp", CAST(user_id AS INT) AS visitorid,
         CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'addtocart'
                         WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
         CAST(json_extract_string(props, '$.k') AS INT) AS itemid,
         CASE WHEN event_type = 'purchase' THEN event_id END AS transactionid
  FROM events)"""

KNOWN = "event IN ('view', 'addtocart', 'transaction')"

BASKET_LOG = """basket_log AS (
  SELECT CAST(year(l_shipdate) AS BIGINT) AS "timestamp", l_orderkey AS visitorid,
         CASE WHEN l_returnflag = 'N' THEN 'view' WHEN l_returnflag = 'R' THEN 'addtocart'
              ELSE 'transaction' END AS event,
         l_suppkey AS itemid,
         CASE WHEN l_returnflag = 'A' THEN l_linenumber END AS transactionid
  FROM lineitem)"""


def _item_props(ts_expr: str) -> str:
    return f"""item_props AS (
  SELECT {ts_expr} AS "timestamp", CAST(l_partkey AS INT) AS itemid,
         CASE WHEN l_returnflag = 'R' AND l_quantity <= 5 THEN 'categoryid'
              ELSE l_returnflag END AS property,
         CAST(l_suppkey % 20 AS VARCHAR) AS value
  FROM lineitem WHERE l_linestatus = 'O'
  UNION ALL
  SELECT {ts_expr}, CAST(l_partkey AS INT),
         CASE WHEN l_returnflag = 'R' AND l_quantity <= 5 THEN 'categoryid'
              ELSE l_returnflag END,
         CAST(l_suppkey % 20 AS VARCHAR)
  FROM lineitem WHERE l_linestatus = 'F')"""


ITEM_PROPS = _item_props("epoch_us(l_shipdate) // 1000")
ITEM_PROPS_YEAR = _item_props("epoch_us(date_trunc('year', l_shipdate)) // 1000")

WEIGHT = """CASE {c} WHEN 'view' THEN 1.0::DOUBLE WHEN 'addtocart' THEN 2.0::DOUBLE
            WHEN 'transaction' THEN 3.0::DOUBLE END"""


def weight(c: str = "event") -> str:
    return WEIGHT.format(c=c)


LATEST = """cat AS (SELECT * FROM item_props WHERE property = 'categoryid'),
m AS (SELECT itemid, max("timestamp") AS "timestamp" FROM cat GROUP BY itemid),
latest AS (SELECT cat.* FROM cat JOIN m USING (itemid, "timestamp"))"""

MODEL1 = f"""SELECT DISTINCT visitorid, CAST(value AS INT) AS categoryid, {weight()} AS rating
FROM click_log JOIN latest USING (itemid) WHERE {KNOWN}"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["model1_matrix"] = with_(CLICK_LOG, ITEM_PROPS, LATEST) + MODEL1

ACTIVE = """active{k} AS (SELECT visitorid, count(*) AS "count" FROM basket_log
  GROUP BY visitorid HAVING count(*) > {k})"""


def active(k: int) -> str:
    return ACTIVE.format(k=k)


def events_of_active(k: int) -> str:
    return f"SELECT b.*, a.\"count\" FROM basket_log b JOIN active{k} a USING (visitorid)"


def model2(k: int = 1) -> str:
    return f"""SELECT visitorid, itemid, {weight()} AS rating
FROM (SELECT DISTINCT * FROM ({events_of_active(k)}))"""


M3 = f"m3 AS (SELECT DISTINCT * FROM ({model2(1)}))"
M1 = f"m1 AS ({MODEL1})"
HASH = "CAST(('0x' || substr(md5(concat_ws('|', {cols})), 1, 7)) AS BIGINT) % {b}"


def hash_bucket(cols: str, buckets: int = 10) -> str:
    return HASH.format(cols=cols, b=buckets)


def split(cols: str) -> str:
    return f"CASE WHEN {hash_bucket(cols)} < 8 THEN 'train' ELSE 'test' END"


SQL.update({
    "scan_events": with_(CLICK_LOG) + "SELECT * FROM click_log",
    "clean_events": with_(CLICK_LOG) + "SELECT visitorid, event, itemid FROM click_log",
    "preview_events": with_(CLICK_LOG) + """SELECT * FROM click_log
ORDER BY "timestamp", visitorid, itemid, event, transactionid NULLS FIRST LIMIT 5""",
    "load_rating_matrix": with_(BASKET_LOG, active(1), M3) + "SELECT * FROM m3",
    "write_read_roundtrip": with_(BASKET_LOG, active(1), M3) + "SELECT * FROM m3",
    "union_item_props": with_(ITEM_PROPS) + "SELECT * FROM item_props",
    "filter_category_props": with_(ITEM_PROPS)
    + "SELECT * FROM item_props WHERE property = 'categoryid'",
    "latest_ts_per_item": with_(ITEM_PROPS, LATEST) + "SELECT * FROM m",
    "latest_category_join": with_(ITEM_PROPS, LATEST) + "SELECT * FROM latest",
    "latest_category_window": with_(ITEM_PROPS, LATEST) + "SELECT * FROM latest",
    "latest_category_ties": with_(ITEM_PROPS_YEAR, LATEST) + "SELECT * FROM latest",
    "events_with_category": with_(CLICK_LOG, ITEM_PROPS, LATEST) + """SELECT *
FROM (SELECT visitorid, event, itemid FROM click_log) e JOIN latest USING (itemid)""",
    "events_per_visitor": with_(BASKET_LOG)
    + "SELECT visitorid, count(*) AS \"count\" FROM basket_log GROUP BY visitorid",
    "active_visitors_gt1": with_(BASKET_LOG, active(1)) + "SELECT * FROM active1",
    "active_visitors_gt2": with_(BASKET_LOG, active(2)) + "SELECT * FROM active2",
    "events_of_active_gt1": with_(BASKET_LOG, active(1)) + events_of_active(1),
    "events_of_active_gt2": with_(BASKET_LOG, active(2)) + events_of_active(2),
    "events_of_active_window": with_(BASKET_LOG, active(1)) + events_of_active(1),
    "events_of_active_semi": with_(BASKET_LOG, active(1))
    + "SELECT * FROM basket_log WHERE visitorid IN (SELECT visitorid FROM active1)",
    "distinct_events_gt1": with_(BASKET_LOG, active(1))
    + f"SELECT DISTINCT * FROM ({events_of_active(1)})",
    "distinct_events_gt2": with_(BASKET_LOG, active(2))
    + f"SELECT DISTINCT * FROM ({events_of_active(2)})",
    "weight_events": with_(BASKET_LOG) + f"SELECT *, {weight()} AS rating FROM basket_log",
    "project_triple": with_(BASKET_LOG)
    + f"SELECT visitorid, itemid, {weight()} AS rating FROM basket_log",
    "model2_matrix": with_(BASKET_LOG, active(1)) + model2(1),
    "model3_matrix": with_(BASKET_LOG, active(1), M3) + "SELECT * FROM m3",
    "model4_matrix": with_(BASKET_LOG, active(2)) + f"SELECT DISTINCT * FROM ({model2(2)})",
    "distinct_users": with_(BASKET_LOG, active(1), M3) + "SELECT DISTINCT visitorid FROM m3",
    "distinct_products": with_(BASKET_LOG, active(1), M3) + "SELECT DISTINCT itemid FROM m3",
    "ratings_per_user": with_(BASKET_LOG, active(1), M3)
    + "SELECT visitorid, count(*) AS \"count\" FROM m3 GROUP BY visitorid",
    "ratings_per_user_stats": with_(BASKET_LOG, active(1), M3) + """SELECT count(c) AS n,
  round(avg(c), 6) AS mean, round(stddev_samp(c), 6) AS stddev, min(c) AS "min", max(c) AS "max"
FROM (SELECT count(*) AS c FROM m3 GROUP BY visitorid)""",
    "user_rating_crosstab": with_(BASKET_LOG, active(1), M3) + """SELECT visitorid,
  count(*) FILTER (WHERE rating = 1.0) AS w1, count(*) FILTER (WHERE rating = 2.0) AS w2,
  count(*) FILTER (WHERE rating = 3.0) AS w3
FROM m3 GROUP BY visitorid""",
    "matrix_profile": with_(BASKET_LOG, active(1), M3) + """SELECT n_ratings, n_users,
  n_products, n_pairs, mean_rating, round(n_ratings / (n_users * n_products), 6) AS density
FROM (SELECT count(*) AS n_ratings, count(DISTINCT visitorid) AS n_users,
        count(DISTINCT itemid) AS n_products,
        (SELECT count(*) FROM (SELECT DISTINCT visitorid, itemid FROM m3
          WHERE visitorid IS NOT NULL AND itemid IS NOT NULL)) AS n_pairs,
        round(avg(rating), 6) AS mean_rating FROM m3)""",
    "stage_counts": with_(CLICK_LOG, ITEM_PROPS, LATEST, M1) + """
SELECT 'events' AS stage, count(*) AS n FROM click_log
UNION ALL SELECT 'item_props_part1', count(*) FROM lineitem WHERE l_linestatus = 'O'
UNION ALL SELECT 'item_props_part2', count(*) FROM lineitem WHERE l_linestatus = 'F'
UNION ALL SELECT 'item_props', count(*) FROM item_props
UNION ALL SELECT 'category_rows', count(*) FROM cat
UNION ALL SELECT 'latest_items', count(*) FROM m
UNION ALL SELECT 'latest_rows', count(*) FROM latest
UNION ALL SELECT 'events_with_category', count(*) FROM click_log JOIN latest USING (itemid)
UNION ALL SELECT 'model1_matrix', count(*) FROM m1""",
    "collapse_pairs": with_(CLICK_LOG) + f"""SELECT visitorid, itemid, count(*) AS n,
  max(r) AS rating_max, round(sum(r), 6) AS rating_sum, round(avg(r), 6) AS rating_mean
FROM (SELECT visitorid, itemid, {weight()} AS r FROM click_log WHERE {KNOWN}) GROUP BY visitorid, itemid""",
    "shift_ratings": with_(CLICK_LOG, ITEM_PROPS, LATEST, M1)
    + "SELECT visitorid, categoryid, rating - 1.5 AS rating FROM m1",
    "split_hash": with_(CLICK_LOG)
    + f"SELECT *, {split('visitorid, itemid, event')} AS split FROM click_log",
    "test_pairs": with_(CLICK_LOG, ITEM_PROPS, LATEST, M1)
    + f"SELECT visitorid, categoryid FROM m1 WHERE {split('visitorid, categoryid')} = 'test'",
})

CLICK_RATINGS = f"""r AS (SELECT DISTINCT visitorid AS "user", itemid AS product, {weight()} AS rating
  FROM click_log WHERE {KNOWN}),
s AS (SELECT *, {split('"user", product')} AS split FROM r),
train AS (SELECT "user", product, rating FROM s WHERE split = 'train'),
test AS (SELECT "user", product, rating FROM s WHERE split = 'test'),
um AS (SELECT "user", avg(rating) AS prediction FROM train GROUP BY "user"),
pred AS (SELECT "user", product, prediction FROM test JOIN um USING ("user")),
sl AS (SELECT "user", product, t.rating, p.prediction FROM test t JOIN pred p USING ("user", product)),
pred_d AS (SELECT "user", product, max(prediction) AS prediction FROM pred GROUP BY "user", product),
sl_d AS (SELECT "user", product, t.rating, p.prediction FROM test t JOIN pred_d p USING ("user", product))"""

FACTORS = """uf AS (SELECT CAST(vec_id // 2 AS INT) AS id, CAST(embedding AS DOUBLE[]) AS features, label
  FROM embeddings WHERE vec_id % 2 = 0),
pf AS (SELECT CAST(vec_id // 2 AS INT) AS id, CAST(embedding AS DOUBLE[]) AS features, label
  FROM embeddings WHERE vec_id % 2 = 1)"""


REGRESSION = """SELECT count(*) AS n,
  round(avg(pow(prediction - rating, 2)), 6) AS mse,
  round(sqrt(avg(pow(prediction - rating, 2))), 6) AS rmse,
  round(avg(abs(prediction - rating)), 6) AS mae,
  round(CASE WHEN var_pop(rating) * count(*) > 0
        THEN 1 - sum(pow(prediction - rating, 2)) / (var_pop(rating) * count(*)) END, 6) AS r2
FROM sl"""

# Split by row: a pair's ratings can be on both sides; predictions meet all of them.
ROW_SPLIT = f"""r AS (SELECT DISTINCT visitorid AS "user", itemid AS product, {weight()} AS rating
  FROM click_log WHERE {KNOWN}),
s AS (SELECT *, {split("\"user\", product, CAST(rating AS DECIMAL(10, 1))")} AS split FROM r),
um AS (SELECT "user", avg(rating) AS prediction FROM s WHERE split = 'train' GROUP BY "user"),
pred AS (SELECT "user", product, prediction FROM s JOIN um USING ("user") WHERE split = 'test'),
sl AS (SELECT "user", product, r.rating, p.prediction FROM r JOIN pred p USING ("user", product))"""


def topn_sql(q: str, c: str, qf: str, cf: str, n: int = 10) -> str:
    return f"""sc_{q} AS (SELECT a.id AS "{q}", b.id AS "{c}",
  list_inner_product(a.features, b.features) AS score FROM {qf} a, {cf} b),
top_{q} AS (SELECT "{q}", CAST(row_number() OVER (PARTITION BY "{q}" ORDER BY score DESC, "{c}")
  AS INT) AS rank, "{c}", score FROM sc_{q} QUALIFY rank <= {n})"""


SQL.update({
    "score_and_labels": with_(CLICK_LOG, CLICK_RATINGS)
    + 'SELECT "user", product, rating, round(prediction, 6) AS prediction FROM sl',
    "score_and_labels_dedup": with_(CLICK_LOG, CLICK_RATINGS)
    + 'SELECT "user", product, rating, round(prediction, 6) AS prediction FROM sl_d',
    "squared_errors": with_(CLICK_LOG, CLICK_RATINGS) + """SELECT "user", product, rating,
  round(prediction, 6) AS prediction, round(pow(prediction - rating, 2), 6) AS sq_err FROM sl""",
    "mse_holdout": with_(CLICK_LOG, CLICK_RATINGS)
    + "SELECT round(avg(pow(prediction - rating, 2)), 6) AS mse FROM sl",
    "rmse_holdout": with_(CLICK_LOG, CLICK_RATINGS)
    + "SELECT round(sqrt(avg(pow(prediction - rating, 2))), 6) AS rmse FROM sl",
    "regression_metrics": with_(CLICK_LOG, CLICK_RATINGS) + REGRESSION,
    "regression_metrics_weighted": with_(CLICK_LOG, CLICK_RATINGS) + REGRESSION,
    "regression_metrics_all_ratings": with_(CLICK_LOG, ROW_SPLIT) + REGRESSION,
    "predict_pairs_from_factors": with_(CLICK_LOG, CLICK_RATINGS, FACTORS) + """SELECT r."user",
  r.product, round(list_inner_product(u.features, p.features), 6) AS prediction
FROM r JOIN uf u ON r."user" = u.id JOIN pf p ON r.product = p.id""",
    "predict_pairs_marked": with_(CLICK_LOG, CLICK_RATINGS, FACTORS) + """SELECT r."user",
  r.product, CASE WHEN u.id IS NOT NULL AND p.id IS NOT NULL
    THEN round(list_inner_product(u.features, p.features), 6) END AS prediction,
  u.id IS NOT NULL AND p.id IS NOT NULL AS known
FROM r LEFT JOIN uf u ON r."user" = u.id LEFT JOIN pf p ON r.product = p.id""",
    "factor_dims": with_(FACTORS) + """SELECT 'user' AS side, id, CAST(len(features) AS INT) AS dim,
  round(features[1], 6) AS f0 FROM uf
UNION ALL SELECT 'product', id, CAST(len(features) AS INT), round(features[1], 6) FROM pf""",
    "topn_products_per_user": with_(FACTORS, topn_sql("user", "product", "uf", "pf"))
    + 'SELECT "user", rank, product, round(score, 6) AS score FROM top_user',
    "topn_users_per_product": with_(FACTORS, topn_sql("product", "user", "pf", "uf"))
    + 'SELECT product, rank, "user", round(score, 6) AS score FROM top_product',
    "ranking_metrics": with_(FACTORS, topn_sql("user", "product", "uf", "pf"), """hits AS (
  SELECT t."user", t.rank, coalesce(CAST(p.label = u.label AS INT), 0) AS hit
  FROM top_user t JOIN pf p ON t.product = p.id JOIN uf u ON t."user" = u.id),
cum AS (SELECT *, sum(hit) OVER (PARTITION BY "user" ORDER BY rank
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM hits),
per_user AS (SELECT "user", sum(CASE WHEN rank <= 10 THEN hit ELSE 0 END) AS hits_k,
  sum(hit * cum / rank) AS ap_sum,
  sum(CASE WHEN rank <= 10 THEN hit * cum / rank ELSE 0.0 END) AS apk_sum,
  sum(CASE WHEN rank <= 10 THEN hit / ln(rank + 1) ELSE 0.0 END) AS dcg FROM cum GROUP BY "user"),
rel AS (SELECT u.id AS "user", coalesce(c.n, 0) AS n_rel FROM uf u
  LEFT JOIN (SELECT label, count(*) AS n FROM pf GROUP BY label) c ON u.label = c.label),
scored AS (SELECT hits_k / 10 AS p,
  CASE WHEN n_rel > 0 THEN hits_k / n_rel ELSE 0.0 END AS rec,
  CASE WHEN n_rel > 0 THEN ap_sum / n_rel ELSE 0.0 END AS ap,
  CASE WHEN n_rel > 0 THEN apk_sum / least(n_rel, 10) ELSE 0.0 END AS apk,
  CASE WHEN n_rel > 0 THEN dcg / list_sum(list_transform(range(1, least(n_rel, 10) + 1),
       lambda i: 1.0 / ln(i + 1))) ELSE 0.0 END AS ndcg
  FROM per_user LEFT JOIN rel USING ("user"))""") + """SELECT count(*) AS users,
  round(avg(ap), 6) AS map, round(avg(apk), 6) AS map_at_k, round(avg(p), 6) AS precision_at_k,
  round(avg(rec), 6) AS recall_at_k, round(avg(ndcg), 6) AS ndcg_at_k FROM scored""",
})

SQL.update({
    "scan_events_csv": with_(CLICK_LOG) + "SELECT * FROM click_log",
    "scan_item_props_csv": with_(ITEM_PROPS) + "SELECT * FROM item_props",
    "recode_events_keep": with_(CLICK_LOG) + """SELECT "timestamp", visitorid, CASE event WHEN 'view' THEN '1'
  WHEN 'addtocart' THEN '2' WHEN 'transaction' THEN '3' ELSE event END AS event, itemid, transactionid
FROM click_log""",
    "weight_events_drop": with_(CLICK_LOG) + f"SELECT *, {weight()} AS rating FROM click_log WHERE {KNOWN}",
})


# Exploration of models 1, 2 and 4, as of model 3 above.
def _profiles(model: int, ctes: str, matrix: str, item: str) -> None:
    head = ctes + f", mat AS MATERIALIZED ({matrix})\n"
    SQL.update({
        f"distinct_users_m{model}": head + "SELECT DISTINCT visitorid FROM mat",
        f"distinct_products_m{model}": head + f"SELECT DISTINCT {item} FROM mat",
        f"ratings_per_user_stats_m{model}": head + """SELECT count(c) AS n,
  round(avg(c), 6) AS mean, round(stddev_samp(c), 6) AS stddev, min(c) AS "min", max(c) AS "max"
FROM (SELECT count(*) AS c FROM mat GROUP BY visitorid)""",
        f"user_rating_crosstab_m{model}": head + """SELECT visitorid,
  count(*) FILTER (WHERE rating = 1.0) AS w1, count(*) FILTER (WHERE rating = 2.0) AS w2,
  count(*) FILTER (WHERE rating = 3.0) AS w3 FROM mat GROUP BY visitorid""",
        f"matrix_profile_m{model}": head + f"""SELECT n_ratings, n_users, n_products, n_pairs, mean_rating,
  round(n_ratings / (n_users * n_products), 6) AS density
FROM (SELECT count(*) AS n_ratings, count(DISTINCT visitorid) AS n_users, count(DISTINCT {item}) AS n_products,
        (SELECT count(*) FROM (SELECT DISTINCT visitorid, {item} FROM mat
          WHERE visitorid IS NOT NULL AND {item} IS NOT NULL)) AS n_pairs,
        round(avg(rating), 6) AS mean_rating FROM mat)""",
    })


_profiles(1, with_(CLICK_LOG, ITEM_PROPS, LATEST), MODEL1, "categoryid")
_profiles(2, with_(BASKET_LOG, active(1)), model2(1), "itemid")
_profiles(4, with_(BASKET_LOG, active(2)), f"SELECT DISTINCT * FROM ({model2(2)})", "itemid")


# Trained models: which rows they give is plain SQL over the hash split; the scores are not.
def _trained(ctes: str, matrix: str, item: str) -> str:
    return ctes + f""", mat AS MATERIALIZED (SELECT visitorid AS "user", CAST({item} AS INT) AS product, rating FROM ({matrix})),
s AS (SELECT CAST("user" AS INT) AS "user", product, rating, {split('"user", product')} AS split FROM mat),
train AS (SELECT * FROM s WHERE split = 'train'), test AS (SELECT * FROM s WHERE split = 'test'),
users AS (SELECT DISTINCT "user" FROM train), products AS (SELECT DISTINCT product FROM train)
"""


_TRAINED1 = _trained(with_(CLICK_LOG, ITEM_PROPS, LATEST), MODEL1, "categoryid")
_TRAINED3 = _trained(with_(BASKET_LOG, active(1), M3), "SELECT * FROM m3", "itemid")
_SCORED = """SELECT "user", product, rating FROM test
WHERE "user" IN (SELECT "user" FROM users) AND product IN (SELECT product FROM products)"""

SQL.update({
    "als_scored_pairs_m1": _TRAINED1 + _SCORED,
    "als_scored_pairs_m3": _TRAINED3 + _SCORED,
    "als_factor_index": _TRAINED1 + """SELECT 'user' AS side, "user" AS id, 10 AS dim FROM users
UNION ALL SELECT 'product', product, 10 FROM products""",
    "als_listed_products": _TRAINED1 + """SELECT "user", CAST(rank AS INT) AS rank FROM users,
  (SELECT unnest(range(1, least(10, (SELECT count(*) FROM products)) + 1)) AS rank)""",
    "als_listed_users": _TRAINED1 + """SELECT product, CAST(rank AS INT) AS rank FROM products,
  (SELECT unnest(range(1, least(10, (SELECT count(*) FROM users)) + 1)) AS rank)""",
})


# ---- pruned and filtered top-N, row-level split, contingency tables, id dictionaries

_UNSEEN = with_(CLICK_LOG, CLICK_RATINGS, FACTORS, """sc AS (SELECT a.id AS "user", b.id AS product,
  list_inner_product(a.features, b.features) AS score FROM uf a, pf b),
lists AS (SELECT "user", CAST(row_number() OVER (PARTITION BY "user" ORDER BY score DESC, product) AS INT) AS rank, product, score
  FROM sc ANTI JOIN train USING ("user", product) QUALIFY rank <= 10)""")

_CONTENT = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in ('"timestamp"', "visitorid", "event", "itemid", "transactionid"))

_STRINGS = """SELECT 'visitor-' || CAST(visitorid AS VARCHAR) AS "user", 'sku-' || CAST({item} AS VARCHAR) AS product, rating FROM {m}
WHERE visitorid IS NOT NULL AND {item} IS NOT NULL"""

SQL.update({
    "topn_products_pruned": SQL["topn_products_per_user"],
    "topn_users_pruned": SQL["topn_users_per_product"],
    "topn_products_unseen": _UNSEEN + 'SELECT "user", rank, product, round(score, 6) AS score FROM lists',
    "ranking_metrics_unseen": _UNSEEN + """, held AS (SELECT DISTINCT "user", product FROM test),
hits AS (SELECT "user", rank, CAST(h.product IS NOT NULL AS INT) AS hit FROM lists l LEFT JOIN held h USING ("user", product)),
cum AS (SELECT *, sum(hit) OVER (PARTITION BY "user" ORDER BY rank) AS cum FROM hits),
sums AS (SELECT "user", sum(hit) AS n_hits, sum(hit * cum / rank) AS ap, sum(hit / ln(rank + 1)) AS dcg FROM cum GROUP BY "user"),
rel AS (SELECT "user", count(*) AS n_rel FROM held GROUP BY "user"),
scored AS (SELECT coalesce(n_hits, 0) / 10 AS p, coalesce(n_hits, 0) / n_rel AS rec, coalesce(ap, 0) / n_rel AS ap,
  coalesce(ap, 0) / least(n_rel, 10) AS apk,
  coalesce(dcg, 0) / list_sum(list_transform(range(1, least(n_rel, 10) + 1), lambda i: 1.0 / ln(i + 1))) AS ndcg
  FROM rel LEFT JOIN sums USING ("user"))
SELECT count(*) AS users, round(avg(ap), 6) AS map, round(avg(apk), 6) AS map_at_k, round(avg(p), 6) AS precision_at_k,
  round(avg(rec), 6) AS recall_at_k, round(avg(ndcg), 6) AS ndcg_at_k FROM scored""",
    "split_rows": with_(CLICK_LOG, """o AS (SELECT *, row_number() OVER (PARTITION BY "timestamp", visitorid, event, itemid, transactionid) - 1
  AS ordinal FROM click_log)""") + f"""SELECT "timestamp", visitorid, event, itemid, transactionid,
  {split(_CONTENT + ", CAST(ordinal AS VARCHAR)")} AS split FROM o""",
    "contingency_levels": with_(CLICK_LOG) + """SELECT event AS level,
  row_number() OVER (ORDER BY event NULLS FIRST) - 1 AS place FROM (SELECT DISTINCT event FROM click_log)""",
    "contingency_wide": with_(CLICK_LOG) + """SELECT itemid, string_agg(CAST(n AS VARCHAR), ',' ORDER BY event NULLS FIRST) AS counts
FROM (SELECT i.itemid, l.event, count(c.event) AS n FROM (SELECT DISTINCT itemid FROM click_log) i
  CROSS JOIN (SELECT DISTINCT event FROM click_log) l
  LEFT JOIN click_log c ON c.itemid IS NOT DISTINCT FROM i.itemid AND c.event = l.event GROUP BY ALL) GROUP BY itemid""",
    "contingency_long": with_(BASKET_LOG) + "SELECT itemid, visitorid, count(*) AS n FROM basket_log GROUP BY ALL",
    "id_round_trip": with_(BASKET_LOG, active(1), M3) + _STRINGS.format(item="itemid", m="m3"),
    "id_dictionary": with_(BASKET_LOG, active(1), M3) + """SELECT side, count(*) AS n, 0 AS lowest, CAST(count(*) - 1 AS INTEGER) AS highest,
  count(*) AS n_ids, count(*) AS n_keys FROM (SELECT DISTINCT 'user' AS side, visitorid AS k FROM m3 WHERE visitorid IS NOT NULL
  UNION ALL SELECT DISTINCT 'product', itemid FROM m3 WHERE itemid IS NOT NULL) GROUP BY side""",
    "als_string_ids_predict": with_(CLICK_LOG, ITEM_PROPS, LATEST, M1) + _STRINGS.format(item="categoryid", m="m1"),
    "als_string_ids_listed": with_(CLICK_LOG, ITEM_PROPS, LATEST, M1) + f"""SELECT "user", CAST(rank AS INT) AS rank
FROM (SELECT DISTINCT "user" FROM ({_STRINGS.format(item="categoryid", m="m1")})),
  (SELECT unnest(range(1, least(10, (SELECT count(DISTINCT categoryid) FROM m1)) + 1)) AS rank)""",
})

# One-pass latest rows, the bucketed matrix store and merged sketches.
for _name, _same in {"latest_category_onepass": "latest_category_join", "latest_category_onepass_ties": "latest_category_ties",
                     "bucketed_ratings_per_user": "ratings_per_user", "bucketed_user_stats": "ratings_per_user_stats",
                     "bucketed_crosstab": "user_rating_crosstab", "stage_counts_observed": "stage_counts", "bucketed_score_and_labels": "score_and_labels"}.items():
    SQL[_name] = SQL[_same]

SQL["sketched_distincts"] = with_(BASKET_LOG) + """SELECT part, count(*) AS n_rows, count(DISTINCT visitorid) AS visitors,
  count(DISTINCT itemid) AS items, true AS visitors_close, true AS items_close
FROM (SELECT CAST("timestamp" AS VARCHAR) AS part, visitorid, itemid FROM basket_log
      UNION ALL SELECT 'all', visitorid, itemid FROM basket_log) GROUP BY part"""
