"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bits of a broadcast bitmap, at most (64 MB).
MAX_BITS = 1 << 29


def work_dir(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; where that is unset and Spark runs on one machine (tests), under a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='hostgrain-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, stored once as Parquet and read back: cuts the lineage and survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """name, lengthened until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def marked(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, name: str) -> DataFrame:
    """rows with a column `name`: false only where the key is none of the wanted ones, without a shuffle of rows.

    A bitmap of hashed keys, 16 bits or more for each of them, is broadcast in pieces
    of 4 KB: about one in 16 other rows is marked, too. It has MAX_BITS at most, so that
    beyond MAX_BITS / 16 keys the share of other rows that are marked grows little by little.
    """
    bits = min(MAX_BITS, 1 << max(20, (16 * wanted.count() - 1).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    own, at, piece, bitmap = (fresh(rows, f"{name}_{x}") for x in ("place", "at", "piece", "map"))
    maps = wanted.groupBy(F.bitmap_bucket_number(place(wanted_key)).alias(piece)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place(wanted_key))).alias(bitmap)
    )
    maps = written(maps, "bitmap")
    placed = rows.withColumn(own, place(key)).withColumn(at, F.bitmap_bit_position(own))
    joined = placed.join(F.broadcast(maps), F.bitmap_bucket_number(own) == F.col(piece), "left")  # MAX_BITS at most
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(F.col(at) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.expr(f"shiftleft(1, cast(`{at}` % 8 as int))")) > 0
    return joined.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias(name))


def without(rows: DataFrame, dropped: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The rows whose keys (column of dropped -> expression on rows, null-safe) aren't among dropped; texts of few others move.

    dropped has these columns only, under names that rows doesn't have, each key once.
    """
    name = fresh(rows, "marked")
    both = marked(rows, F.struct(*keys.values()), dropped, F.struct(*map(F.col, keys)), name)
    condition = F.lit(True)
    for column, key in keys.items():
        condition = condition & F.col(column).eqNullSafe(key)
    kept = both.where(~F.col(name)).unionByName(both.where(F.col(name)).join(dropped, condition, "left_anti"))
    return kept.select(*rows.columns)


def tidy(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """f, a function of batches, which in the end gives memory that it no longer uses back to the system.

    Python workers outlive their tasks; what Arrow and the C library hold on to
    would add to what the next stage needs.
    """

    @functools.wraps(f)
    def run(batches: Iterator) -> Iterator:
        import pyarrow

        try:
            yield from f(batches)
        finally:
            pyarrow.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim is not None:
                trim(0)

    return run
