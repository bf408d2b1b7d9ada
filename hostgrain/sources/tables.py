"""Landing files and the partitioned tables of each layer."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from hostgrain.functions.columns import as_long, day_of
from hostgrain.operators.contract import COLUMNS
from hostgrain.sources.events import EventSource, source


class EmptyRange(ValueError):
    """No event lies in the days asked for."""


def _first(line: Column) -> Column:
    """The first field; unlike split_part() this doesn't take the whole line apart."""
    return F.substring_index(line, ",", 1)


def _reason(line: Column) -> Column:
    """Why a raw line can't be landed; null for one that can."""
    first = _first(line)
    return F.when(~F.contains(line, F.lit(",")), "no fields").when(F.trim(first) == "", "no time").when(as_long(first).isNull(), "time is no number")


def land(lines: DataFrame, path: str, name: str, first_day: int, last_day: int) -> None:
    """Writes raw lines (column value) of the days first_day..last_day as gzip CSV, a folder for each day, in one pass.

    Lines that have no day, for want of fields or of a number as their time, go to the
    folder of the null day: see landing_rejects(). Days without lines are left out; no
    line in the whole range is an error. Rewriting a day replaces it. Gzip can't be
    split, so Spark cuts the files by volume (spark.sql.adaptive.advisoryPartitionSizeInBytes).
    """
    rejected = _reason(F.col("value")).isNotNull()
    time = as_long(_first(F.col("value")))
    chosen = lines.select("value", F.when(~rejected, day_of(time)).alias("day")).where(rejected | F.col("day").between(first_day, last_day))
    seen = Observation()
    apart = max(64, 4 * (last_day - first_day + 1))  # so that few days share a partition before it is cut
    dealt = chosen.hint("rebalance", apart, F.col("day")).observe(seen, F.count("day").alias("landed"))
    _replace(dealt, ["day"]).option("compression", "gzip").format("text").save(f"{path}/{name}")
    if not seen.get.get("landed"):
        raise EmptyRange(f"{name}: no event in days {first_day} to {last_day}")


def landing_rejects(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(source, reason, line) of the lines that land() couldn't place."""
    lines = spark.read.schema(StructType().add("line", StringType()).add("day", IntegerType())).text(f"{path}/{name}").where("day is null")
    return lines.select(F.lit(name).alias("source"), _reason(F.col("line")).alias("reason"), "line")


def scan_landing(spark: SparkSession, path: str, name: str, first_day: int | None = None, last_day: int | None = None, with_day: bool = False) -> DataFrame:
    """The raw fields of landed lines, all strings, empty ones null, of the days asked for; with_day: also the landing_day."""
    spec = source(name)
    files = spark.read.schema(spec.raw_schema.add("day", IntegerType())).option("header", False).csv(f"{path}/{name}")
    landing_day = [F.col("day").alias("landing_day")] if with_day else []
    return _between(files, first_day, last_day).select(*spec.fields, *landing_day)


def landing_digests(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(day, files, sha256): a digest of the sorted digests of each day's files, computed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(f"{path}/{name}")
    each = files.select(F.regexp_extract("path", r"day=(-?\d+)/", 1).try_cast("int").alias("day"), F.sha2("content", 256).alias("digest"))
    # a day has few files, so the list is short
    return each.where("day is not null").groupBy("day").agg(
        F.count(F.lit(1)).alias("files"), F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), ","), 256).alias("sha256")
    )


def _replace(df: DataFrame, partitions: list[str]):
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)


def write_table(df: DataFrame, path: str, partitions: list[str], fmt: str = "parquet") -> None:
    """Writes df; partitions that it holds are replaced, others stay, so a repeated run changes nothing."""
    _replace(df, partitions).format(fmt).save(path)


def stored(df: DataFrame, name: str, partitions: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """The rows of df, computed and written once under scratch(): several parts of a query read them."""
    path = scratch(df.sparkSession, name)
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str) -> tuple:
    """The store that holds path, and path for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file of exactly this name, replacing an older one."""
    store, place = file_system(spark, path)
    out = store.create(place, True)
    out.write(bytearray(text.encode()))
    out.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """As write_text(), but a reader finds the old file or the new one, whatever happens in between."""
    jvm, hidden = spark._jvm, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    write_text(spark, hidden, text)
    place = jvm.org.apache.hadoop.fs.Path
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(place(path).toUri(), spark._jsc.hadoopConfiguration()).rename(place(hidden), place(path), overwrite)


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    store, place = file_system(spark, path)
    content = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(content, "UTF-8")
    finally:
        content.close()


def _between(df: DataFrame, first_day: int | None, last_day: int | None) -> DataFrame:
    if first_day is not None:
        df = df.where(F.col("day") >= first_day)
    return df if last_day is None else df.where(F.col("day") <= last_day)


def scan_bronze(spark: SparkSession, path: str, spec: EventSource, first_day: int, last_day: int | None = None) -> DataFrame:
    """A source's Bronze rows of one day or a range: only those partitions are read."""
    rows = spark.read.parquet(path).where(F.col("source") == spec.name)
    return _between(rows, first_day, first_day if last_day is None else last_day).select(*spec.fields, "source", "day")


def scan_silver(spark: SparkSession, path: str, anchor_day: int, window_days: int) -> DataFrame:
    """Silver rows of the window that ends at anchor_day."""
    return _between(spark.read.parquet(path), anchor_day - window_days + 1, anchor_day)


def scan_gold(spark: SparkSession, path: str, anchors: list[int], window_days: int) -> DataFrame:
    """Feature rows of the anchors in the contract's column order; a missing column is an error."""
    rows = spark.read.parquet(path)
    missing = [c for c in COLUMNS if c not in rows.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return rows.where((F.col("window_days") == window_days) & F.col("anchor_day").isin(*anchors)).select(*COLUMNS)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir, which all executors share; only on one machine (tests) may that be unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='hostgrain-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
