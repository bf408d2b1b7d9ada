"""Robust anomaly scores of computers, their drivers, and risk levels; all deliveries at once.

Scores need medians per (delivery, feature). They are taken on (value, count)
pairs, cut into narrow ranges, so no task holds a group; the table of medians has
a row per delivery and feature, which Spark broadcasts or not by its size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostgrain.functions.labels import labelled
from hostgrain.operators.contract import FEATURES, FLAGS, KEYS
from hostgrain.sources.tables import stored

DELIVERY = ("window_days", "anchor_day")
# Scale of the median deviation, shares of the risk levels.
MAD_SCALE = 1.4826
HIGH_SHARE = 0.01
ATTENTION_SHARE = 0.05
#: Ranges of values for each unit: of the logarithms of counts, 1/4096 is a quarter of a thousandth.
STEPS = 4096


def scored_features(df: DataFrame) -> list[str]:
    """The numeric columns that are neither keys nor flags nor the score, in order."""
    skip = {*KEYS, *FLAGS, "anomaly_score", "risk"}
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    return [c for c, kind in df.dtypes if c not in skip and kind.startswith(numeric)]


def _cells(features: DataFrame, columns: list[str]) -> DataFrame:
    """(delivery, computer, position, feature, x): a row per cell with a value."""
    entries = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    long = features.select(*DELIVERY, "computer_id", F.explode(entries).alias("e")).select(*DELIVERY, "computer_id", "e.*")
    return long.select(*DELIVERY, "computer_id", "position", "feature", F.log1p(F.greatest("v", F.lit(0.0))).alias("x"), "v").where("v is not null")


def _medians(counted: DataFrame, keys: list[str], x: str) -> DataFrame:
    """(keys, median): the exact median of x, which isn't negative, over rows that count n times.

    Counts per narrow range of x find the ranges that hold the middle; only the
    values within these are put in order. No task gets all values of a group, but
    those of one range, 1/STEPS wide.
    """
    ranged = counted.withColumn("range", F.floor(F.col(x) * STEPS))
    whole, upto = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("range")
    sizes = ranged.groupBy(*keys, "range").agg(F.sum("n").alias("size"))
    placed = sizes.withColumns({"total": F.sum("size").over(whole), "before": F.sum("size").over(upto) - F.col("size")})
    middle = placed.withColumns({"low": F.floor((F.col("total") - 1) / 2), "high": F.floor(F.col("total") / 2)})
    middle = middle.where("before <= high and before + size > low").select(*keys, "range", "before", "low", "high")
    inside = ranged.join(middle, [*keys, "range"]).withColumn("reached", F.col("before") + F.sum("n").over(Window.partitionBy(*keys, "range").orderBy(x)))
    holds = lambda place: (F.col("reached") - F.col("n") <= place) & (F.col("reached") > place)
    ends = [F.max(F.when(holds(F.col(place)), F.col(x))) for place in ("low", "high")]
    return inside.groupBy(*keys).agg(((ends[0] + ends[1]) / 2).alias("median"))


def _scales(cells: DataFrame) -> DataFrame:
    """(delivery, feature, median, scale)."""
    keys = [*DELIVERY, "feature"]
    counted = stored(cells.groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("n")), "values")
    means = counted.groupBy(*keys).agg(F.sum("n").alias("rows"), (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mean"))
    middle = stored(_medians(counted, keys, "x").join(means, keys), "medians")
    away = counted.join(middle, keys).withColumn("far", F.abs(F.col("x") - F.col("median")))
    squares = F.sum((F.col("x") - F.col("mean")) ** 2 * F.col("n"))
    spread = away.groupBy(*keys).agg(F.sqrt(squares / F.nullif(F.max("rows") - 1, F.lit(0))).alias("deviation"))
    far = away.groupBy(*keys, "far").agg(F.sum("n").alias("n"))
    mads = _medians(far, keys, "far").withColumnRenamed("median", "mad")
    fallback = F.when(F.col("deviation") == 0, F.lit(1.0)).otherwise(F.col("deviation"))
    scale = F.when(F.col("mad") > 0, F.col("mad") * MAD_SCALE).otherwise(fallback)
    return middle.join(spread, keys).join(mads, keys).select(*keys, "median", scale.alias("scale"))


def deviations(features: DataFrame) -> DataFrame:
    """(delivery, computer_id, position, feature, abs_z); abs_z is null in a delivery of one row."""
    cells = _cells(features, scored_features(features))
    joined = cells.join(_scales(cells), [*DELIVERY, "feature"])
    return joined.select(*DELIVERY, "computer_id", "position", "feature", F.abs((F.col("x") - F.col("median")) / F.col("scale")).alias("abs_z"))


def anomaly_scores(features: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """(delivery, computer_id, anomaly_score): the mean of a computer's deviations (found, or worked out here), 0 without any."""
    mean = (deviations(features) if found is None else found).groupBy(*DELIVERY, "computer_id").agg(F.avg("abs_z").alias("score"))
    everyone = features.select(*DELIVERY, "computer_id")
    return everyone.join(mean, [*DELIVERY, "computer_id"], "left").select(
        *DELIVERY, "computer_id", F.round(F.coalesce("score", F.lit(0.0)), 6).alias("anomaly_score")
    )


def contributions(features: DataFrame, top: int = 5, found: DataFrame | None = None) -> DataFrame:
    """(delivery, computer_id, feature, abs_z, rank): the features that deviate most; ties in contract order."""
    order = Window.partitionBy(*DELIVERY, "computer_id").orderBy(F.desc(F.round("abs_z", 6)), "position")
    ranked = (deviations(features) if found is None else found).where("abs_z is not null").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select(*DELIVERY, "computer_id", "feature", F.round("abs_z", 6).alias("abs_z"), "rank")


def _level(place: Column, n: Column) -> Column:
    high = F.greatest(F.lit(1), F.floor(n * F.lit(HIGH_SHARE)))
    attention = F.greatest(high, F.floor(n * F.lit(ATTENTION_SHARE)))
    return F.when(place <= high, "High").when(place <= attention, "Medium").otherwise("Normal")


def _running(rows: DataFrame, order: list, sums: dict[str, Column], name: str) -> DataFrame:
    """rows with, for each of sums, its total over the delivery (`all_`) and over the rows up to this one in order (`upto_`).

    Rows are dealt out in that order, in ranges of about equal size; a running sum is
    that of the ranges before plus that within the range, so a large delivery is
    worked on by many tasks, whatever the ties. Rows must differ in order.
    """
    dealt = rows.repartitionByRange(*DELIVERY, *order).withColumn("range", F.spark_partition_id())
    dealt = stored(dealt, name)
    whole, upto = Window.partitionBy(*DELIVERY), Window.partitionBy(*DELIVERY).orderBy("range")
    ranges = dealt.groupBy(*DELIVERY, "range").agg(*[F.sum(c).alias(k) for k, c in sums.items()])  # a row for each range of a delivery
    before = [x for k in sums for x in (F.sum(k).over(whole).alias(f"all_{k}"), (F.sum(k).over(upto) - F.col(k)).alias(f"before_{k}"))]
    within = Window.partitionBy(*DELIVERY, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = dealt.withColumns({f"inside_{k}": F.sum(c).over(within) for k, c in sums.items()})
    joined = inside.join(ranges.select(*DELIVERY, "range", *before), [*DELIVERY, "range"])
    found = [x for k in sums for x in (F.col(f"all_{k}"), (F.col(f"before_{k}") + F.col(f"inside_{k}")).alias(f"upto_{k}"))]
    return joined.select(*rows.columns, *found)


def risk_levels(scores: DataFrame) -> DataFrame:
    """Adds place (by descending score, then id, within a delivery) and risk: High, Medium or Normal."""
    order = [F.desc(F.coalesce("anomaly_score", F.lit(0.0))), F.col("computer_id")]
    placed = _running(scores, order, {"n": F.lit(1)}, "dealt").withColumn("place", F.col("upto_n").cast("int"))
    return placed.withColumn("risk", _level(F.col("place"), F.col("all_n"))).select(*scores.columns, "place", "risk")


def label_quality(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """(delivery, computers, labelled, auc, average_precision) of scores against the labelled computers (delivery, computer_id).

    auc is the chance that a labelled computer has a higher score than another one,
    equal scores counting half; null where one sort is missing. The average precision
    takes each score as a threshold; null without a labelled computer. Both are sums
    over the distinct scores of a delivery, by running sums over ranges of them.
    """
    hit = labels.select(*DELIVERY, "computer_id").distinct().withColumn("hit", F.lit(1))
    marked = scores.join(hit, [*DELIVERY, "computer_id"], "left").withColumn("score", F.coalesce("anomaly_score", F.lit(0.0)))
    levels = marked.groupBy(*DELIVERY, "score").agg(F.count(F.lit(1)).alias("rows"), F.count("hit").alias("hits"))
    run = _running(levels, [F.desc("score")], {"rows": F.col("rows"), "hits": F.col("hits")}, "levels")
    others, below = F.col("all_rows") - F.col("all_hits"), (F.col("all_rows") - F.col("upto_rows")) - (F.col("all_hits") - F.col("upto_hits"))
    wins = F.col("hits") * (below + (F.col("rows") - F.col("hits")) / 2)
    precision = F.col("hits") * F.col("upto_hits") / F.col("upto_rows")
    total = run.groupBy(*DELIVERY).agg(
        F.max("all_rows").alias("computers"), F.max("all_hits").alias("labelled"), F.max(others).alias("others"), F.sum(wins).alias("wins"), F.sum(precision).alias("precision")
    )
    auc = F.when((F.col("labelled") > 0) & (F.col("others") > 0), F.round(F.col("wins") / (F.col("labelled") * F.col("others")), 6))
    average = F.when(F.col("labelled") > 0, F.round(F.col("precision") / F.col("labelled"), 6))
    return total.select(*DELIVERY, "computers", "labelled", auc.alias("auc"), average.alias("average_precision"))


def attention(scores: DataFrame) -> DataFrame:
    return risk_levels(scores).where(F.col("risk").isin("High", "Medium"))


def top_computers(scores: DataFrame, n: int = 15) -> DataFrame:
    """The n highest scores of all rows; ties by computer."""
    return scores.orderBy(F.desc("anomaly_score"), "computer_id").limit(n).select("computer_id", "anomaly_score")


def driver_rows(drivers: DataFrame, computer_id: str, n: int = 5) -> DataFrame:
    """The first n drivers of one computer with their labels."""
    own = drivers.where((F.col("computer_id") == computer_id) & (F.col("rank") <= n))
    return labelled(own).select("rank", "feature", "label", "abs_z").orderBy("rank")


def standouts(scores: DataFrame, drivers: DataFrame, n: int = 5) -> DataFrame:
    """(computer_id, sentence) for those of the n highest scores that need attention."""
    top = attention(scores).orderBy(F.desc("anomaly_score"), "computer_id").limit(n)
    reason = labelled(drivers.where("rank = 1")).select("computer_id", F.lower("label").alias("reason"))
    # The wording of the sentences.
    unknown = F.lit("activity that looks unusual compared with the rest of the group")
    return top.join(reason, "computer_id", "left").select(
        "computer_id",
        F.concat(F.lit("**"), "computer_id", F.lit("** — "), "risk", F.lit(" risk: unusually high "), F.coalesce("reason", unknown), F.lit(".")).alias("sentence"),
    )


assert math.isclose(ATTENTION_SHARE, 5 * HIGH_SHARE) and len(FEATURES) == 28
