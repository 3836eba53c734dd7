"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

NORMALISED = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

TO_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS = rf"regexp_extract_all({TO_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {
    "op8_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({NORMALISED}) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op11_term_trie": f"""
        WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, {TERMS} AS terms FROM documents),
        s AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS total FROM d),
        i AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark),
        t AS (SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest(terms) AS term FROM d)
              WHERE term IN (SELECT term FROM i) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
              FROM t, s GROUP BY term, n_docs),
        m AS (SELECT row_no, doc_id, 100 - 50 + ((50 * len(terms)::BIGINT * n_docs) // total) AS m FROM d, s WHERE total > 0),
        r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
              FROM i JOIN t USING (term) JOIN w USING (term) JOIN m USING (row_no) GROUP BY item_id, row_no, doc_id)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
            FROM r WHERE score > 0) WHERE rank <= 50""",
    "op13_phrase_streams": f"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                          unnest(regexp_split_to_array({TO_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
        t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
        g AS (SELECT lang, unnest(flatten(list_transform(range(1, 6), lambda k:
                     list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])))) AS ph FROM w),
        f AS (SELECT lang, ph, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
        inside AS (SELECT lang, unnest(flatten(list_transform(range(2, len(ph)), lambda k:
                     list_transform(range(1, len(ph) - k + 2), lambda i: ph[i:i + k - 1])))) AS ph, f FROM f),
        longer AS (SELECT lang, ph, max(f) AS longer FROM inside GROUP BY ALL),
        c AS (SELECT lang, ph, f AS a FROM f LEFT JOIN longer USING (lang, ph)
              WHERE len(ph) >= 2 AND NOT coalesce(100 * longer >= 100 * f, false)),
        k AS (SELECT *, unnest(range(1, len(ph))) AS k FROM c),
        s AS (SELECT k.*, l.f AS l, r.f AS r, n,
                     ((1000::HUGEINT * a::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT))::BIGINT AS score
              FROM k JOIN t USING (lang) JOIN f l ON l.lang = k.lang AND l.ph = k.ph[1:k.k]
              JOIN f r ON r.lang = k.lang AND r.ph = k.ph[k.k + 1:]),
        b AS (SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) AS nth FROM s),
        o AS (SELECT lang, array_to_string(ph, ' ') AS phrase, a, l, r, n, score FROM b WHERE nth = 1)
        SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score FROM (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
        WHERE rank <= 2000""",
}
