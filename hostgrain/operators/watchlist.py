"""The ranked list of computers that need attention, and figures about it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostgrain.functions.labels import FAMILIES, family_of, labelled
from hostgrain.operators.scoring import DELIVERY, attention, risk_levels

CAP = 50
# Fixed value: the reason given where no driver is known.
NO_REASON = "Unusual activity"


def filtered(scores: DataFrame, risk: str = "all", search: str = "") -> DataFrame:
    """Computers that need attention: of one risk level if asked, whose id holds the text (any case, taken literally)."""
    of_level = F.lower("risk") == risk if risk in ("high", "medium") else F.lit(True)
    named = F.contains(F.lower("computer_id"), F.lower(F.lit(search.strip())))  # any id contains the empty text
    return attention(scores).where(of_level & named)


def watchlist(scores: DataFrame, drivers: DataFrame, risk: str = "all", search: str = "", cap: int = CAP) -> DataFrame:
    """(delivery, rank, computer_id, reason, risk, score): filtered, then ranked, then capped per delivery."""
    order = Window.partitionBy(*DELIVERY).orderBy(F.desc("anomaly_score"), "computer_id")
    ranked = filtered(scores, risk, search).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cap)
    keys = [*DELIVERY, "computer_id"]
    reason = labelled(drivers.where("rank = 1")).select(*keys, F.col("label").alias("reason"))
    joined = ranked.join(reason, keys, "left")
    return joined.select(*DELIVERY, "rank", "computer_id", F.coalesce("reason", F.lit(NO_REASON)).alias("reason"), "risk", F.col("anomaly_score").alias("score"))


def watchlist_total(scores: DataFrame, risk: str = "all", search: str = "") -> DataFrame:
    """How many computers the filter leaves, before any cap."""
    return filtered(scores, risk, search).agg(F.count(F.lit(1)).alias("total"))


def first_drivers(scores: DataFrame, drivers: DataFrame) -> DataFrame:
    """(delivery, computer_id, feature): the first driver of each computer that needs attention."""
    keys = [*DELIVERY, "computer_id"]
    return drivers.where("rank = 1").join(attention(scores).select(*keys), keys, "left_semi").select(*keys, "feature")


def driver_frequency(scores: DataFrame, drivers: DataFrame, n: int = 5) -> DataFrame:
    counts = first_drivers(scores, drivers).groupBy("feature").agg(F.count(F.lit(1)).alias("computers"))
    return labelled(counts.orderBy(F.desc("computers"), "feature").limit(n)).select("feature", "label", "computers")


def attention_by_family(scores: DataFrame, drivers: DataFrame) -> DataFrame:
    named = first_drivers(scores, drivers).withColumn("family", family_of(F.col("feature"))).where("family is not null")
    label = F.create_map(*[F.lit(x) for pair in FAMILIES.items() for x in pair])
    counts = named.groupBy("family").agg(F.count(F.lit(1)).alias("computers"))
    return counts.select("family", label[F.col("family")].alias("label"), "computers")


def triage_kpis(scores: DataFrame, drivers: DataFrame) -> DataFrame:
    """One row: computers, how many need attention, the highest, and the most common first driver."""
    levels = risk_levels(scores)
    order = F.struct("anomaly_score", F.negative("place"))
    head = levels.agg(
        F.count(F.lit(1)).alias("computers"),
        F.count_if(F.col("risk").isin("High", "Medium")).alias("attention"),
        F.count_if(F.col("risk") == "High").alias("high"),
        F.count_if(F.col("risk") == "Medium").alias("medium"),
        F.max_by("computer_id", order).alias("highest_id"),
        F.max("anomaly_score").alias("highest_score"),
        F.max_by("risk", order).alias("highest_risk"),
    )
    theme = driver_frequency(scores, drivers, 1).agg(F.max("label").alias("theme_label"), F.coalesce(F.max("computers"), F.lit(0).cast("long")).alias("theme_count"))
    return head.join(F.broadcast(theme))  # two rows of one
