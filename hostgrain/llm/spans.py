"""Spans found in texts: (kind, start, end) by code points, end exclusive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Span = tuple[str, int, int]


def span_columns(found: DataFrame, kinds: tuple[str, ...], base: tuple[str, ...]) -> DataFrame:
    """doc_id, the number of spans of each base kind, the digest of the base spans, and all spans."""
    place = F.expr("array(" + ",".join(f"'{k}'" for k in kinds) + ")")

    def text(spans):
        ordered = F.array_sort(
            F.transform(
                spans,
                lambda s: F.struct(
                    s["start"].alias("start"), F.array_position(place, s["kind"]).alias("place"), s["end"].alias("end"), s["kind"].alias("kind")
                ),
            )
        )
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    of_base = F.filter("spans", lambda s: s["kind"].isin(*base))
    return found.select(
        "doc_id", *[count(k) for k in base], F.sha2(text(of_base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans")
    )
