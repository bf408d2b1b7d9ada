"""Mixing sources to target weights: capped water-filling and seeded repetitions (DataFrame functions only).

The target of a source is min(cap, level * weight), where one level is set so
that the targets add up to the wanted total: the fixed point of clamping sources
at their cap and sharing the excess by weight. Documents of a source are ordered
by a seeded digest; all are taken floor(target / size) times, and those whose
running total stays nearest the remaining fraction once more. The order is cut
into digest buckets, so the running total of a hot source is computed by many
tasks and then shifted by the totals of the buckets before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostgrain.llm.storage import fresh, table, written

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORDS)).cast("long")


def water_fill(sources: DataFrame, total_share: float, max_epochs: int) -> DataFrame:
    """Adds column target to (source, weight, source_size); a row per source, weights above 0.

    Sources in order of cap / weight: the first ones are clamped, as long as the
    level left for the others is above their own ratio. Sources without words get 0.
    """
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    stepped = (
        sources.withColumn("cap", F.col("source_size") * F.lit(max_epochs))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(total_share)))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weights_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("wanted") - F.col("caps_before")) / F.col("weights_left"))
        .withColumn("clamped", F.col("level") * F.col("weight") > F.col("cap"))
    )
    # the first source in order that isn't clamped sets the level of all others
    final = F.min(F.when(~F.col("clamped"), F.struct(F.col("caps_before"), F.col("level")))).over(everything)["level"]
    return stepped.withColumn("final", final).select(
        "source",
        "weight",
        "source_size",
        F.when(F.col("final").isNull() | (F.col("final") * F.col("weight") > F.col("cap")), F.col("cap").cast("double"))
        .otherwise(F.col("final") * F.col("weight"))
        .alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    buckets: int = 4096,
    text_key: str | None = None,
) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken; with text_key also the source and, under this name, a hash of the text.

    size counts words (a null text has 0). Sources in code point order, null
    last, get the weights in turn. taken = size * repetitions, between 0 and
    max_epochs; per source it is within the size of one document of the target.
    Rows of equal id and size (repeated rows) follow one another in the order;
    the choice depends on seed, id and size only (with text_key also on the text), so
    reruns agree. Very long texts are counted whole. Other columns are ignored. An empty table gives no rows; a source without words has target 0.
    """
    slots = 16 ** 3
    step = max(1, slots // max(1, min(buckets, slots)))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    hashed = [F.xxhash64(F.col(text_col)).alias("text_hash")] if text_key else []
    rows = written(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            order.alias("place"),
            *hashed,
        ),
        "sizes",
    ).withColumn("bucket", F.floor(F.conv(F.substring("place", 1, 3), 16, 10).cast("int") / F.lit(step)).cast("int"))
    by_bucket = written(rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")), "buckets")
    sizes = by_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % F.lit(len(weights))
    targets = water_fill(
        sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))),
        total_share,
        max_epochs,
    )
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_bucket.withColumn("before", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
    frame = (
        offsets.join(targets, offsets["source"].eqNullSafe(targets["source"]))
        .select(offsets["source"].alias("s"), F.col("bucket").alias("b"), "before", "source_size", "target")
    )
    frame = written(frame, "mix-plan")
    inside = Window.partitionBy("source", "bucket").orderBy("place", "id", "size", *(["text_hash"] if text_key else [])).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = rows.withColumn("upto", F.sum("size").over(inside))
    joined = running.join(frame, running["source"].eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(epochs)
    rest = F.col("target") - whole * F.col("source_size")
    # once more, if the middle of the document's stretch of the running total lies within the rest
    again = (F.col("before") + F.col("upto")) * 2 - F.col("size") < rest * 2
    return joined.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("size") * (whole + again.cast("int"))).cast("long").alias("taken"),
        *([running["source"].alias(source_col), F.col("text_hash").alias(text_key)] if text_key else []),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """docs with each row as often as mix_sources() takes it: the same columns, 0 to max_epochs copies.

    Rows that share an id, but differ in text or source, have their own number
    each; rows that repeat id, source and text share the larger one. A document
    without words is taken once: it adds no word to any source, and no decision of
    the mix speaks against it.
    """
    id_col, text_col, source_col = (options.get(x, y) for x, y in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")))
    key, source, text, times, copy = (fresh(docs, f"mixed_{x}") for x in ("id", "source", "text", "times", "copy"))
    verdict = mix_sources(docs, **options, text_key=text).where("size > 0")
    taken = verdict.groupBy(F.col(id_col).alias(key), F.col(source_col).alias(source), text).agg(
        F.max(F.expr("cast(taken div size as int)")).alias(times)
    )
    same = F.col(id_col).eqNullSafe(F.col(key)) & F.col(source_col).eqNullSafe(F.col(source)) & (F.xxhash64(F.col(text_col)) == F.col(text))
    joined = docs.join(taken, same, "left")
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.coalesce(F.col(times), F.lit(1))))).select(
        *docs.columns
    )


def op10(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))


QUERIES = {"op10_source_mix": op10}
ORACLES = {
    "op10_source_mix": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                   md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS place
            FROM documents
        ), s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
            FROM d GROUP BY source
        ), fill(n, level) AS (
            SELECT 0, (SELECT sum(source_size) * 1.5::DOUBLE / sum(weight) FROM s)
            UNION ALL
            SELECT n + 1, (SELECT (sum(source_size) * 1.5::DOUBLE
                                   - coalesce(sum(2 * source_size) FILTER (fill.level * weight > 2 * source_size), 0))
                                  / sum(weight) FILTER (NOT fill.level * weight > 2 * source_size) FROM s)
            FROM fill WHERE n < 200
        ), t AS (
            SELECT source, source_size,
                   least(2.0::DOUBLE * source_size, (SELECT level FROM fill WHERE n = 200) * weight) AS target FROM s
        ), r AS (
            SELECT d.*, t.source_size, t.target,
                   sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto,
                   CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, source_size, target,
               (size * (whole + (upto * 2 - size < (target - whole * source_size) * 2)::INT))::BIGINT AS taken
        FROM r
    """
}
