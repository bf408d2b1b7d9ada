"""Exact de-duplication with a heavy-hitter split (DataFrame functions only).

A Misra-Gries style sketch (Spark's approx_top_k, a frequent-items summary of
fixed size) names digests that may be frequent. Their winners are verified by an
exact aggregate and broadcast, so that the copies of a frequent text are settled
map-side and never meet in one task; all other digests go through an ordinary
shuffle of (digest, id), whose groups are then small. Texts never shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostgrain.llm.storage import fresh, table, without, written

#: At most so many digests are broadcast (64 bytes each).
HEAVY_DIGESTS = 1_000
#: Counters of the frequent-items sketch: a digest with more than about 1/TRACKED of the rows is found.
TRACKED = 16_384


def text_digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    heavy: int = HEAVY_DIGESTS,
    tracked: int = TRACKED,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Equal texts have equal SHA-256 of their UTF-8; a null text equals the empty
    one. The row with the largest id stays. Rows that repeat both id and text are
    the same document and share its verdict. A null id never wins over another;
    a group with null ids only has keep_id null and keeps its rows. Any other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    rows = written(docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest")), "digests")
    found = rows.agg(F.expr(f"approx_top_k(digest, {heavy}, {tracked})").alias("top")).select(
        F.explode("top.item").alias("digest")
    )
    candidates = rows.join(F.broadcast(found), "digest", "left_semi")
    winners = written(
        candidates.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "winners"
    )
    bounded = F.broadcast(winners)  # `heavy` rows at most
    frequent = rows.join(bounded, "digest")
    same = Window.partitionBy("digest")
    rest = rows.join(bounded, "digest", "left_anti").select(
        "digest",
        "id",
        F.max("id").over(same).alias("keep_id"),
        F.count(F.lit(1)).over(same).alias("group_size"),
    )
    return frequent.select("digest", "id", "keep_id", "group_size").unionByName(rest).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_one_copy(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without those that exact_duplicates() drops, with all their columns.

    Only texts of dropped rows and of a few others are shuffled. Rows that repeat
    both id and text are one document: all of them stay or go.
    """
    verdict = exact_duplicates(docs, id_col, text_col)
    key, digest = fresh(docs, "dropped_id"), fresh(docs, "dropped_digest")
    dropped = (
        verdict.where(~F.col("kept")).select(F.col(id_col).alias(key), F.col("text_sha256").alias(digest)).distinct()
    )
    return without(docs, written(dropped, "dropped"), {key: F.col(id_col), digest: text_digest(F.col(text_col))})


def op7(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op7_exact_dedup": op7}
ORACLES = {
    "op7_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM d
    """
}
