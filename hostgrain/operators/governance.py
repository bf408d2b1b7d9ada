"""Lineage, checksum and schema records as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LAYERS = ("landing", "bronze", "silver", "gold", "delivered")
CHECKSUM_KEYS = ("layer", "source", "day", "window_days")


def layer_counts(df: DataFrame, layer: str, by: tuple[str, ...] = ("source", "day")) -> DataFrame:
    """(layer, source, day, record_count) of a table."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(layer).alias("layer"), *by, "record_count")


def lineage_rows(counts: DataFrame, from_layer: str | None, to_layer: str, schema_version: str = "v1") -> DataFrame:
    """A lineage record for each row of counts (source, day, record_count, window_days if it has any)."""
    window = F.col("window_days") if "window_days" in counts.columns else F.lit(None).cast("int")
    origin = F.col("source") if "source" in counts.columns else F.lit(None).cast("string")
    return counts.select(
        origin.alias("source"),
        "day",
        F.lit(from_layer).cast("string").alias("from_layer"),
        F.lit(to_layer).alias("to_layer"),
        "record_count",
        F.lit(schema_version).alias("schema_version"),
        window.alias("window_days"),
    )


def upsert(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = CHECKSUM_KEYS, by: tuple[str, ...] = ("created_at",)) -> DataFrame:
    """The rows of both, and of each key only the one with the latest created_at (or `by`); null keys are equal."""
    latest = Window.partitionBy(*keys).orderBy(*map(F.desc, by), F.desc("generation"))
    both = old.withColumn("generation", F.lit(0)).unionByName(new.withColumn("generation", F.lit(1)))
    return both.withColumn("place", F.row_number().over(latest)).where("place = 1").drop("place", "generation")


def checksum_counts(records: DataFrame, layers: list[str], first_day: int, last_day: int) -> DataFrame:
    """The records of some layers and days, by layer, source, day and window."""
    chosen = records.where(F.col("layer").isin(*layers) & F.col("day").between(first_day, last_day))
    return chosen.select(*CHECKSUM_KEYS, "record_count").orderBy(*[F.asc_nulls_first(k) for k in CHECKSUM_KEYS])


def volume_summary(records: DataFrame, anchor_day: int, window_days: int, delivered: int) -> DataFrame:
    """(layer, source, day, record_count) behind one delivery: landing to Silver of its window's days, Gold and delivered.

    Gold is the record of exactly this anchor and window, or else the delivered count.
    """
    first = max(0, anchor_day - window_days + 1)
    upstream = records.where(F.col("layer").isin(*LAYERS[:3]) & F.col("day").between(first, anchor_day)).select(
        "layer", "source", "day", F.coalesce("record_count", F.lit(0)).cast("long").alias("record_count")
    )
    exact = records.where((F.col("layer") == "gold") & (F.col("day") == anchor_day) & (F.col("window_days") == window_days))
    gold = exact.agg(F.coalesce(F.max("record_count"), F.lit(delivered)).cast("long").alias("record_count"))
    ends = gold.select(F.lit("gold").alias("layer"), "record_count").union(
        gold.select(F.lit("delivered").alias("layer"), F.lit(delivered).cast("long").alias("record_count"))
    )
    return upstream.unionByName(
        ends.select("layer", F.lit(None).cast("string").alias("source"), F.lit(anchor_day).alias("day"), "record_count")
    )


def nested_volume(deliveries: DataFrame, records: DataFrame) -> DataFrame:
    """(window_days, anchor_day, volume_summary) for each delivery (window_days, anchor_day, record_count).

    The summary holds the event days, the records of landing to Silver on these days
    by source and day, and the counts of Gold (of exactly this anchor and window, or
    else the delivered one) and of the delivery.
    """
    keys = ["window_days", "anchor_day"]
    days = F.sequence(F.greatest(F.lit(0), F.col("anchor_day") - F.col("window_days") + 1), F.col("anchor_day"))
    own = deliveries.select(*keys, F.col("record_count").alias("delivered"), days.alias("event_days"))
    upstream = records.where(F.col("layer").isin(*LAYERS[:3])).select("layer", "source", "day", F.coalesce("record_count", F.lit(0)).cast("long").alias("record_count"))
    entry = F.struct("source", "day", "record_count")
    lists = [F.array_sort(F.collect_list(F.when(F.col("layer") == layer, entry))).alias(layer) for layer in LAYERS[:3]]
    behind = own.select(*keys, F.explode("event_days").alias("day")).join(upstream, "day", "left").groupBy(*keys).agg(*lists)
    gold = records.where("layer = 'gold'").groupBy("window_days", F.col("day").alias("anchor_day")).agg(F.max("record_count").cast("long").alias("gold"))
    joined = own.join(behind, keys).join(gold, keys, "left")
    summary = F.struct(
        "bronze",
        F.struct(F.col("delivered").alias("record_count")).alias("delivered"),
        "event_days",
        F.struct("anchor_day", F.coalesce("gold", "delivered").alias("record_count"), "window_days").alias("gold"),
        "landing",
        "silver",
    )
    return joined.select(*keys, summary.alias("volume_summary"))


def layer_totals(summary: DataFrame) -> DataFrame:
    """(layer_order, layer, record_count) for all layers; null where a layer has no row."""
    order = summary.sparkSession.createDataFrame(list(enumerate(LAYERS)), "layer_order int, layer string")
    sums = summary.groupBy("layer").agg(F.sum("record_count").alias("record_count"))
    return order.join(sums, "layer", "left").select("layer_order", "layer", "record_count")


def phase_deltas(summary: DataFrame) -> DataFrame:
    """(phase, rows_before, rows_after, delta) of each step from layer to layer; five rows come in, four go out."""
    after = Window.orderBy("layer_order")
    hop = layer_totals(summary).select(
        F.concat_ws(" to ", "layer", F.lead("layer").over(after)).alias("phase"),
        F.col("record_count").alias("rows_before"),
        F.lead("record_count").over(after).alias("rows_after"),
        F.lead("layer").over(after).alias("next"),
    )
    return hop.where("next is not null").select("phase", "rows_before", "rows_after", (F.col("rows_after") - F.col("rows_before")).alias("delta"))
