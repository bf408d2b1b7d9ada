"""Headline figures of a delivery."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Which features make up a figure.
FIGURES = {
    "sign_ins": ("auth_out_event_count", "auth_in_event_count"),
    "failed_sign_ins": ("auth_out_failed_count", "auth_in_failed_count"),
    "program_starts": ("proc_start_count",),
    "network_connections": ("flows_out_count_distinct", "flows_in_count_distinct"),
    "network_bytes": ("flows_out_bytes_sum_distinct", "flows_in_bytes_sum_distinct"),
    "web_lookups": ("dns_lookup_count",),
}
MIX = {"Sign-ins": "sign_ins", "Programs": "program_starts", "Network": "network_connections", "Web lookups": "web_lookups"}


def row_total(df: DataFrame, columns: tuple[str, ...]) -> Column:
    """The sum of those of the columns that df has; null counts as 0."""
    present = [F.coalesce(F.col(c), F.lit(0)).cast("long") for c in columns if c in df.columns]
    return reduce(Column.__add__, present, F.lit(0).cast("long"))


def activity_totals(df: DataFrame) -> DataFrame:
    sums = [F.coalesce(F.sum(row_total(df, columns)), F.lit(0).cast("long")).alias(name) for name, columns in FIGURES.items()]
    return df.agg(F.count(F.lit(1)).alias("computers"), *sums)


def sign_in_success_rate(df: DataFrame) -> DataFrame:
    """The share of sign-ins that didn't fail, between 0 and 1; null without sign-ins."""
    share = F.lit(1.0) - F.col("failed_sign_ins") / F.col("sign_ins")
    return activity_totals(df).select(
        F.when(F.col("sign_ins") > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(share, 6)))).alias("success_rate")
    )


def activity_mix(df: DataFrame) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(label).alias("activity"), F.col(name).alias("events")) for label, name in MIX.items()])
    return activity_totals(df).select(F.inline(entries))


def top_computers_by(df: DataFrame, columns: tuple[str, ...], n: int = 8) -> DataFrame:
    """The n computers with the largest total above 0; ties by computer."""
    totals = df.select("computer_id", row_total(df, columns).alias("value"))
    return totals.where("value > 0").orderBy(F.desc("value"), "computer_id").limit(n)


def source_health(df: DataFrame) -> DataFrame:
    """(source, delivered): whether a source is flagged present on all rows; not without rows or the flag."""
    names = ("auth", "proc", "flows", "dns")
    flags = [F.coalesce(F.bool_and(f"source_present_{n}"), F.lit(False)) if f"source_present_{n}" in df.columns else F.lit(False) for n in names]
    entries = F.array(*[F.struct(F.lit(n).alias("source"), F.col(n).alias("delivered")) for n in names])
    return df.agg(*[f.alias(n) for f, n in zip(flags, names)]).select(F.inline(entries))


def delivery_overview(manifests: DataFrame) -> DataFrame:
    """Deliveries, newest first."""
    return manifests.select(
        "anchor_day",
        "window_days",
        F.col("record_count").alias("records"),
        F.col("schema_version").alias("schema"),
        "created_at",
        F.concat(F.substring("checksum_sha256", 1, 12), F.lit("...")).alias("checksum"),
    ).orderBy(F.desc("created_at"), F.desc("window_days"), F.desc("anchor_day"))


def find_manifest(manifests: DataFrame, window_days: int | None = None, anchor_day: int | None = None) -> DataFrame:
    """The manifest of a delivery, or the newest one."""
    if window_days is not None and anchor_day is not None:
        return manifests.where((F.col("window_days") == window_days) & (F.col("anchor_day") == anchor_day))
    return manifests.orderBy(F.desc("created_at"), F.desc("window_days"), F.desc("anchor_day")).limit(1)
