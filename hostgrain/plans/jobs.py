"""Jobs from layer to layer, for a range of days at a time.

Each job stages its rows, takes their counts and checksums while they are written,
holds what it read against the checksums recorded for it, and only then publishes
the partitions that it was asked for by one commit record. So a layer is read once by
the job that needs it, and never again to check it; a job that fails leaves the old
state as it was; and no day but those of the job changes.
"""

from __future__ import annotations

import functools
import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from hostgrain.functions.columns import as_long, day_of
from hostgrain.operators.contract import COLUMNS
from hostgrain.operators.features import ALIKE, daily, daily_schema, features_of_days, window_event_days
from hostgrain.operators.integrity import Watch, content_checksum, content_checksum_md5, missing_partitions
from hostgrain.plans.delivery import deliver
from hostgrain.sources.events import SOURCES, source
from hostgrain.sources.published import CommitLog, Published
from hostgrain.sources.tables import scan_landing, write_text

_MANIFEST_RECORD = (
    "dataset", "dataset_version", "schema_version", "window_days", "anchor_day", "record_count", "checksum_sha256", "encryption_scheme", "key_id", "data_object", "created_at"
)
_CHECKSUMS = "layer string, source string, day int, window_days int, checksum string, record_count long, created_at string"
_SCHEMAS = "source string, layer string, schema_version string, columns array<string>, created_at string"
_LINEAGE = "source string, day int, from_layer string, to_layer string, record_count long, schema_version string, window_days int, created_at string"
#: What a job does about a day without rows: it fails, or it publishes that the day is empty.
FAIL, REMOVE = "fail", "remove"


@functools.cache
def silver_schema(spark: SparkSession, name: str) -> StructType:
    spec = source(name)
    return spec.to_silver(spec.to_bronze(spark.createDataFrame([], spec.raw_schema))).schema


@functools.cache
def gold_schema(spark: SparkSession) -> StructType:
    return features_of_days(spark.createDataFrame([], daily_schema()), 0, 0, 1).schema


class Lake:
    """The tables under one folder: Bronze, Silver, daily sums and Gold, and records of schemas, deliveries and lineage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        for name in ("bronze", "silver", "daily"):
            setattr(self, name, Published(spark, self.path(name), ("source", "day")))
        self.gold = Published(spark, self.path("gold"), ("window_days", "anchor_day"))
        self._schemas = CommitLog(spark, self.path("schemas"), ("source", "layer", "schema_version"))
        self._deliveries = CommitLog(spark, self.path("deliveries"), ("window_days", "anchor_day"))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # what was published

    def records(self, layer: str, names: Iterable[str], first_day: int, last_day: int) -> dict[tuple[str, int], dict]:
        """The records of Bronze, Silver or daily partitions with rows, by source and day."""
        names = set(names)
        inside = lambda r: r["source"] in names and first_day <= r["day"] <= last_day and r["record_count"] > 0
        return {(r["source"], r["day"]): r for r in getattr(self, layer).records(inside)}

    def bronze_rows(self, name: str, records: Iterable[dict]) -> DataFrame:
        schema = source(name).raw_schema.add("source", StringType()).add("day", IntegerType())
        rows = self.bronze.read(StructType(schema.fields).add("outcome", StringType()), [r for r in records if r["source"] == name])
        return rows.where("outcome = 'accepted'").select(*schema.names)

    def silver_rows(self, name: str, records: Iterable[dict]) -> DataFrame:
        return self.silver.read(silver_schema(self.spark, name), [r for r in records if r["source"] == name])

    def gold_rows(self, first_anchor: int, last_anchor: int, window_days: int) -> DataFrame:
        return self.gold.read(gold_schema(self.spark), self._gold_records(first_anchor, last_anchor, window_days))

    def _gold_records(self, first_anchor: int, last_anchor: int, window_days: int) -> list[dict]:
        return self.gold.records(lambda r: r["window_days"] == window_days and first_anchor <= r["anchor_day"] <= last_anchor and r["record_count"] > 0)

    def rejected_rows(self) -> DataFrame:
        """(source, landing_day, reason, line): rows that Bronze didn't accept, by the folder that they were found in."""
        parts = []
        for name, spec in SOURCES.items():
            schema = StructType(spec.raw_schema.add("source", StringType()).add("day", IntegerType()).fields).add("outcome", StringType())
            rows = self.bronze.read(schema, self.bronze.records(lambda r: r["source"] == name and r.get("rejected", 0) > 0))  # noqa: B023
            line = F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in spec.fields]).alias("line")
            parts.append(rows.where("outcome <> 'accepted'").select("source", F.col("day").alias("landing_day"), F.col("outcome").alias("reason"), line))
        return reduce(DataFrame.unionByName, parts)

    def checksums(self, first_day: int | None = None, last_day: int | None = None) -> DataFrame:
        """(layer, source, day, window_days, checksum, record_count, created_at) of each partition that is there, in some days or all."""
        rows = []
        for r in self.bronze.records():
            rows.append(("landing", r["source"], r["day"], None, r["landing_checksum"], r["landing_count"], r["created_at"]))
        for layer in ("bronze", "silver"):
            rows += [(layer, r["source"], r["day"], None, r["checksum"], r["record_count"], r["created_at"]) for r in getattr(self, layer).records()]
        rows += [("gold", None, r["anchor_day"], r["window_days"], r["checksum"], r["record_count"], r["created_at"]) for r in self.gold.records()]
        inside = lambda r: r[5] > 0 and (first_day is None or r[2] >= first_day) and (last_day is None or r[2] <= last_day)
        return self.spark.createDataFrame([r for r in rows if inside(r)], _CHECKSUMS)

    def schemas(self) -> DataFrame:
        """(source, layer, schema_version, columns, created_at) as last registered."""
        rows = [tuple(r[c] for c in StructType.fromDDL(_SCHEMAS).names) for r in self._schemas.current().values()]
        return self.spark.createDataFrame(rows, _SCHEMAS)

    def deliveries(self) -> DataFrame:
        rows = [tuple(r[c] for c in _MANIFEST_RECORD) for r in self._deliveries.current().values()]
        kinds = {"window_days": "int", "anchor_day": "int", "record_count": "long"}
        return self.spark.createDataFrame(rows, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in _MANIFEST_RECORD))

    # what a job adds

    def register(self, layer: str, columns: dict[str, list[str]], created_at: str) -> None:
        rows = [{"source": s, "layer": layer, "schema_version": "v1", "columns": names, "created_at": created_at} for s, names in columns.items()]
        known = self._schemas.current()
        if changed := [r for r in rows if known.get(self._schemas.key(r), {}).get("columns") != r["columns"]]:
            self._schemas.commit(changed)

    def add_lineage(self, from_layer: str | None, to_layer: str, rows: list[tuple], created_at: str) -> None:
        """Adds a record for each (source, day, record_count, window_days): a small file of its own, which nobody changes."""
        names = ("source", "day", "record_count", "window_days")
        records = [dict(zip(names, r, strict=True)) | {"from_layer": from_layer, "to_layer": to_layer, "schema_version": "v1", "created_at": created_at} for r in rows]
        if records:
            write_text(self.spark, self.path(f"lineage/{uuid.uuid4().hex}.json"), "\n".join(map(json.dumps, records)))

    def lineage(self) -> DataFrame:
        """All lineage records, as lineage_rows() makes them, with created_at."""
        return self.spark.read.schema(_LINEAGE).json(self.path("lineage"))


def _each(items: Iterable, f: Callable) -> list:
    """f of each item, their Spark jobs side by side; the first error is raised."""
    items = list(items)
    with ThreadPoolExecutor(len(items)) as pool:
        return list(pool.map(f, items))


#: Days of a source that one write takes: each of them that is watched adds to the work for a row, and each write to that of the driver.
PIECE = 5
#: How the contents of Bronze and Silver are summed up; records that don't name it are of the time when that was MD5.
DIGEST = "xxhash64"


def _pieces(first: int, last: int, size: int = PIECE) -> list[tuple[int, int]]:
    return [(a, min(a + size - 1, last)) for a in range(first, last + 1, size)]


def _by_day(df: DataFrame, first: int, last: int) -> DataFrame:
    """df dealt out by day, a large day to several tasks: its files follow its volume, not the number of tasks."""
    return df.hint("rebalance", 4 * (last - first + 1), F.col("day"))


def _require_days(layer: str, found: Iterable[tuple[str, int]], names: list[str], first_day: int, last_day: int) -> None:
    """Raises unless every source has rows on every day."""
    found = set(found)
    if gaps := [(n, d) for n in names for d in range(first_day, last_day + 1) if (n, d) not in found]:
        raise ValueError(f"{layer}: no rows of {', '.join(f'{n} on day {d}' for n, d in gaps[:10])}")


def _require_same(records: dict[tuple[str, int], dict], seen: dict[tuple[str, int], tuple[int, str]], rows: Callable[[str, list[dict]], DataFrame], layer: str) -> None:
    """Raises unless what a job read of a layer is what was recorded for it.

    A task that had to run twice before a shuffle may have been counted twice, so what
    differs is computed once more on its own before it counts as changed.
    """
    differing = [r for key, r in records.items() if seen.get(key, (0, ""))[1] != r["checksum"]]
    bad = []
    for name in sorted({r["source"] for r in differing}):
        own = [r for r in differing if r["source"] == name]
        for checksum, digest in ((content_checksum, DIGEST), (content_checksum_md5, None)):
            if alike := [r for r in own if r.get("digest") == digest]:
                now = {r.day: r.checksum for r in checksum(rows(name, alike), ("source", "day")).collect()}
                bad += [(name, r["day"]) for r in alike if now.get(r["day"]) != r["checksum"]]
    if bad:
        raise ValueError(f"upstream content can't be trusted: {layer} of {', '.join(f'{n} day {d}' for n, d in bad[:10])}")


def to_bronze(lake: Lake, landing: str, names: list[str], first_day: int, last_day: int, created_at: str, empty_days: str = FAIL) -> DataFrame:
    """Landing to Bronze for all sources and days; returns (source, day, record_count, checksum) of what was published.

    Replaces exactly these partitions. A row belongs to the day of the folder that it
    landed in; one whose time says another day (`misfiled`) or is no number
    (`undated`) is kept aside with that partition, see Lake.rejected_rows(). A day
    without accepted rows fails the job before anything is published, or, where
    empty_days is `remove`, is empty from then on.
    """
    since = lake.bronze.log.version()
    records: dict[tuple[str, int], dict] = {}

    def write(name: str, first: int, last: int) -> None:
        spec = source(name)
        raw = scan_landing(lake.spark, landing, name, first, last, with_day=True)
        rows = raw.withColumn("source", F.lit(name)).withColumnRenamed("landing_day", "day")
        own_day = day_of(as_long(F.col("time")))
        outcome = F.when(own_day.isNull(), "undated").when(own_day != F.col("day"), "misfiled").otherwise("accepted")
        columns = [*spec.fields, "source", "day"]
        watch = Watch("day", range(first, last + 1), columns, {"landing": "true", "bronze": "outcome = 'accepted'"}, DIGEST)
        run = lake.bronze.stage(watch.on(rows.withColumn("outcome", outcome).select(*columns, "outcome")), ("outcome",))
        kept = watch.found("bronze")
        for day, (landed, checksum) in watch.found("landing").items():
            count, own = kept.get(day, (0, ""))
            records[name, day] = {
                "source": name, "day": day, "record_count": count, "checksum": own, "digest": DIGEST, "created_at": created_at,
                "landing_count": landed, "landing_checksum": checksum, "rejected": landed - count, "run": run,
            }

    _each([(n, *piece) for n in names for piece in _pieces(first_day, last_day)], lambda job: write(*job))
    accepted = {k for k, r in records.items() if r["record_count"]}
    if empty_days == FAIL:
        _require_days("bronze", accepted, names, first_day, last_day)
    gone = [{"source": n, "day": d} for n in names for d in range(first_day, last_day + 1) if (n, d) not in records]
    lake.bronze.publish(records.values(), gone, since)
    fields = {n: list(SOURCES[n].fields) for n in names}
    lake.register("landing", fields, created_at)
    lake.register("bronze", {n: [*f, "source", "day"] for n, f in fields.items()}, created_at)
    landed = [(r["source"], r["day"], r["landing_count"], None) for r in records.values()]
    lake.add_lineage(None, "landing", landed, created_at)
    return _done(lake, "landing", "bronze", [r for r in records.values() if r["record_count"]], created_at)


def _done(lake: Lake, from_layer: str, layer: str, records: list[dict], created_at: str) -> DataFrame:
    lake.add_lineage(from_layer, layer, [(r["source"], r["day"], r["record_count"], None) for r in records], created_at)
    rows = [(r["source"], r["day"], r["record_count"], r["checksum"]) for r in records]
    return lake.spark.createDataFrame(rows, "source string, day int, record_count long, checksum string")


def quarantine_counts(lake: Lake) -> DataFrame:
    """(source, landing_day, rows) of the rows that to_bronze() didn't accept."""
    return lake.rejected_rows().groupBy("source", "landing_day").agg(F.count(F.lit(1)).alias("rows"))


def to_silver(lake: Lake, names: list[str], first_day: int, last_day: int, created_at: str, empty_days: str = FAIL) -> DataFrame:
    """Bronze to Silver; returns (source, day, record_count, checksum) of what was published.

    Bronze is read once, and held against its recorded checksums before anything is
    published; a day without rows fails the job or, where empty_days is `remove`, is
    empty from then on.
    """
    since = lake.silver.log.version()
    upstream = lake.records("bronze", names, first_day, last_day)
    if empty_days == FAIL:
        _require_days("silver", upstream, names, first_day, last_day)
    records: dict[tuple[str, int], dict] = {}
    seen: dict[tuple[str, int], tuple[int, str]] = {}
    columns: dict[str, list[str]] = {}

    def write(name: str, first: int, last: int) -> None:
        own = [r for (n, day), r in upstream.items() if n == name and first <= day <= last]
        if not own:
            return
        bronze = lake.bronze_rows(name, own)
        before = Watch("day", range(first, last + 1), bronze.columns, digest=DIGEST)
        silver = SOURCES[name].to_silver(before.on(bronze))
        after = Watch("day", range(first, last + 1), silver.columns, digest=DIGEST)
        columns[name] = silver.columns
        run = lake.silver.stage(after.on(silver))  # as the shuffle that drops repeated rows left them: few days, tasks by volume
        seen.update({(name, day): v for day, v in before.found().items()})
        for day, (count, checksum) in after.found().items():
            records[name, day] = {"source": name, "day": day, "record_count": count, "checksum": checksum, "digest": DIGEST, "created_at": created_at, "run": run}

    _each([(n, *piece) for n in names for piece in _pieces(first_day, last_day)], lambda job: write(*job))
    _require_same(upstream, seen, lake.bronze_rows, "bronze")
    gone = [{"source": n, "day": d} for n in names for d in range(first_day, last_day + 1) if (n, d) not in records]
    lake.silver.publish(records.values(), gone, since)
    lake.register("silver", columns, created_at)
    return _done(lake, "bronze", "silver", list(records.values()), created_at)


def to_daily(lake: Lake, first_day: int, last_day: int) -> dict[tuple[str, int], dict]:
    """Brings the daily sums and values in line with Silver, and returns their records.

    Only the (source, day) partitions whose Silver changed since they were made are
    read, once, and held against their recorded checksums.
    """
    since = lake.daily.log.version()
    silver = lake.records("silver", SOURCES, first_day, last_day)
    known = lake.records("daily", SOURCES, first_day, last_day)
    stale = {k: r for k, r in silver.items() if known.get(k, {}).get("built_from") != r["checksum"]}
    gone = [{"source": n, "day": d} for n, d in known if (n, d) not in silver]
    if stale or gone:
        seen: dict[tuple[str, int], tuple[int, str]] = {}
        runs: dict[tuple[str, int], str] = {}

        def write(name: str, first: int, last: int) -> None:
            own = [r for (n, day), r in stale.items() if n == name and first <= day <= last]
            if own:
                rows = lake.silver_rows(name, own)
                watch = Watch("day", [r["day"] for r in own], rows.columns, digest=DIGEST)
                run = lake.daily.stage(_by_day(daily({name: watch.on(rows)}, alike=ALIKE), first, last), ("part",))
                runs.update({(name, r["day"]): run for r in own})
                seen.update({(name, day): v for day, v in watch.found().items()})

        _each([(n, *piece) for n in SOURCES for piece in _pieces(first_day, last_day)], lambda job: write(*job))
        _require_same(stale, seen, lake.silver_rows, "silver")
        made = [{"source": n, "day": d, "record_count": r["record_count"], "built_from": r["checksum"], "run": runs[n, d]} for (n, d), r in stale.items()]
        lake.daily.publish(made, gone, since)
        known = lake.records("daily", SOURCES, first_day, last_day)
    return known


def _built_from(days: dict[tuple[str, int], dict], anchor: int, window_days: int) -> str:
    """A digest of the Silver contents that an anchor's window is made of."""
    window = window_event_days(anchor, window_days)
    inside = sorted((n, d, r["built_from"]) for (n, d), r in days.items() if window[0] <= d <= window[-1])
    return hashlib.sha256(repr(inside).encode()).hexdigest()


def _ranges(values: list[int]) -> list[tuple[int, int]]:
    """Ascending whole numbers as ranges of neighbours that one Watch can hold."""
    found: list[tuple[int, int]] = []
    for v in values:
        if found and v == found[-1][1] + 1 and v - found[-1][0] < Watch.MOST:
            found[-1] = found[-1][0], v
        else:
            found.append((v, v))
    return found


def stale_anchors(lake: Lake, days: dict[tuple[str, int], dict], first_anchor: int, last_anchor: int, window_days: int) -> list[int]:
    """The anchors whose Gold isn't there or was made from other contents of its window's days."""
    known = {r["anchor_day"]: r.get("built_from") for r in lake.gold.records(lambda r: r["window_days"] == window_days)}
    return [a for a in range(first_anchor, last_anchor + 1) if known.get(a) != _built_from(days, a, window_days)]


def build_gold(lake: Lake, first_anchor: int, last_anchor: int, window_days: int, created_at: str, empty_days: str = FAIL) -> list[int]:
    """Silver to Gold for the anchors whose windows changed, in one plan for neighbours; returns them.

    Every record of Gold says which contents of Silver it was made from; an anchor
    is made again only where those of its window's days are others. All are published
    at once. An anchor without a computer fails the job, or is empty from then on.
    """
    since = lake.gold.log.version()
    first_day = window_event_days(first_anchor, window_days)[0]
    days = to_daily(lake, first_day, last_anchor)
    stale = stale_anchors(lake, days, first_anchor, last_anchor, window_days)
    records: list[dict] = []
    for first, last in _ranges(stale):
        start = window_event_days(first, window_days)[0]
        own = [r for (_, day), r in days.items() if start <= day <= last]
        if not own:
            continue
        gold = features_of_days(lake.daily.read(daily_schema(), own), first, last, window_days)
        watch = Watch("anchor_day", range(first, last + 1), COLUMNS)
        run = lake.gold.stage(watch.on(gold))
        records += [
            {"window_days": window_days, "anchor_day": a, "record_count": n, "checksum": c, "created_at": created_at, "run": run, "built_from": _built_from(days, a, window_days)}
            for a, (n, c) in watch.found().items()
        ]
    made = {r["anchor_day"] for r in records}
    if empty := [a for a in stale if a not in made]:
        if empty_days == FAIL:
            raise ValueError(f"no computer was active in the window of anchors {', '.join(map(str, empty[:10]))}")
    if stale:
        gone = [{"window_days": window_days, "anchor_day": a} for a in empty]
        lake.gold.publish(records, gone, since)
        lake.register("gold", {"gold": list(COLUMNS)}, created_at)
        lake.add_lineage("silver", "gold", [(None, r["anchor_day"], r["record_count"], window_days) for r in records], created_at)
    return stale


def deliver_windows(lake: Lake, path: str, first_anchor: int, last_anchor: int, window_days: int, secret: str, created_at: str) -> DataFrame:
    """Gold to a delivery for each anchor; returns the manifests, which are recorded, too.

    Gold is read once, while it is sealed, and no manifest is written unless what was
    read agrees with the recorded checksums.
    """
    records = lake._gold_records(first_anchor, last_anchor, window_days)
    checks = {(r["window_days"], r["anchor_day"]): (r["record_count"], r["checksum"]) for r in records}
    gold = lake.gold_rows(first_anchor, last_anchor, window_days)
    manifests = deliver(gold, path, secret, created_at, lake.checksums(), checks)
    rows = manifests.select(*_MANIFEST_RECORD).collect()  # a row per delivery
    lake._deliveries.commit([r.asDict() for r in rows])
    lake.add_lineage("gold", "delivered", [(None, r.anchor_day, r.record_count, r.window_days) for r in rows], created_at)
    return manifests


def backfill(lake: Lake, landing: str, first_day: int, last_day: int, window_days: int, created_at: str) -> DataFrame:
    """All layers for a range of days, and Gold for each of them as an anchor."""
    to_bronze(lake, landing, list(SOURCES), first_day, last_day, created_at)
    to_silver(lake, list(SOURCES), first_day, last_day, created_at)
    build_gold(lake, first_day, last_day, window_days, created_at)
    return lake.gold_rows(first_day, last_day, window_days)


def reprocess_window(lake: Lake, landing: str, anchor_day: int, window_days: int, created_at: str) -> DataFrame:
    """Rebuilds one window; every source must have landed on every day of it."""
    days = window_event_days(anchor_day, window_days)
    landed = [lake.spark.read.text(f"{landing}/{n}").select(F.lit(n).alias("source"), F.col("day").cast("int").alias("day")) for n in SOURCES]
    gaps = missing_partitions(reduce(DataFrame.union, landed), list(SOURCES), days).orderBy("day", "source").limit(20).collect()
    if gaps:
        raise ValueError(f"not landed: {', '.join(f'{r.source} day {r.day}' for r in gaps)}")
    to_bronze(lake, landing, list(SOURCES), days[0], days[-1], created_at)
    to_silver(lake, list(SOURCES), days[0], days[-1], created_at)
    build_gold(lake, anchor_day, anchor_day, window_days, created_at)
    return lake.gold_rows(anchor_day, anchor_day, window_days)


def late_day(lake: Lake, landing: str, names: list[str], day: int, window_days: int, created_at: str, last_anchor: int) -> list[int]:
    """Takes in a day of some sources that landed again, and rebuilds the windows that hold it; returns their anchors.

    Anchors are brought up to date from the day on; those whose window doesn't hold it
    keep their rows and record.
    """
    to_bronze(lake, landing, names, day, day, created_at, REMOVE)
    to_silver(lake, names, day, day, created_at, REMOVE)
    return build_gold(lake, day, last_anchor, window_days, created_at, REMOVE)
