"""Row counts of a chain's stages, gathered while the chain runs.

Each count is an ``Observation`` in a job that does the stage's own work, so no log is read for
its sake. Spark applies an observation once per partition only in a job's last stage: in an
earlier one, a task that is run again after its shuffle files were lost counts twice. So every
step here ends in a written table, and its counts sit behind its last shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path
from .joins import DEFAULT_MAX_BROADCAST_BYTES, Dimension
from .prep import filter_property, latest_ts_per_key, union_parts, weight_events


@dataclass
class StageCounts:
    """``n``: rows per stage name, filled in as the steps are written."""

    n: dict[str, int] = field(default_factory=dict)
    _watched: list[tuple[str, Observation]] = field(default_factory=list)
    _paths: list[str] = field(default_factory=list)

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        """``df``, counted in the next ``write``. No shuffle may lie between."""
        seen = Observation()
        self._watched.append((stage, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def write(self, df: DataFrame, keep: bool = False) -> DataFrame:
        """``df`` written to the shared scratch folder and read again; what was watched in it
        is counted. ``clear`` removes it unless ``keep``."""
        spark = df.sparkSession
        path = scratch_path(spark, "audited")
        df.write.parquet(path)
        if not keep:
            self._paths.append(path)
        for stage, seen in self._watched:
            self.n[stage] = seen.get["n"]
        self._watched.clear()
        return spark.read.schema(df.schema).parquet(path)

    def clear(self, spark) -> None:
        for path in self._paths:
            remove_path(spark, path)
        self._paths.clear()


def audited_category_matrix(events: DataFrame, props_parts: list[DataFrame], on_unknown: str = "error",
                            max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> tuple[DataFrame, dict[str, int]]:
    """Model 1's matrix (as ``category_matrix``) and the rows after each stage, from one run:
    ``item_props_part1`` ..., ``item_props``, ``category_rows``, ``latest_items``,
    ``latest_rows``, ``events``, ``events_with_category``, ``model1_matrix``.

    It writes what the plain chain streams: the category rows, the latest rows and the joined
    (visitor, category, weight) rows before their distinct. Where the latest rows are too many
    to broadcast, the events are shuffled for their join and are counted by a job of their own."""
    spark, counts = events.sparkSession, StageCounts()
    parts = [counts.watch(p, f"item_props_part{i}") for i, p in enumerate(props_parts, 1)]
    props = counts.watch(union_parts(*parts), "item_props")
    cats = counts.write(counts.watch(filter_property(props, "categoryid"), "category_rows"))
    items = Dimension.of(latest_ts_per_key(cats, "itemid", "timestamp"))
    counts.n["latest_items"] = items.rows
    latest = items.joined_to(cats, ["itemid", "timestamp"], max_broadcast_bytes=max_broadcast_bytes)
    latest = Dimension.of(counts.write(counts.watch(latest, "latest_rows")))

    # A join with an empty side is planned away, and the count before it too.
    if latest.rows and latest.size <= max_broadcast_bytes:
        events = counts.watch(events, "events")
    else:
        counts.n["events"] = events.count()
    # Labels without a weight have a category too; they go (or fail) behind the count.
    placed = latest.select("itemid", F.col("value").cast("int").alias("categoryid")).joined_to(
        events.select("visitorid", "itemid", "event"), "itemid", max_broadcast_bytes=max_broadcast_bytes)
    weighed = weight_events(counts.watch(placed, "events_with_category"), on_unknown=on_unknown)
    triples = counts.write(weighed.select("visitorid", "categoryid", "rating"))
    matrix = counts.write(counts.watch(triples.distinct(), "model1_matrix"), keep=True)
    counts.clear(spark)
    return matrix, counts.n
