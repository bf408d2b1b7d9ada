"""Deliveries of feature tables: sealed partitions, manifests, and what the receiver checks."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hostgrain.operators.contract import COLUMNS, FLAGS
from hostgrain.operators.governance import nested_volume
from hostgrain.operators.integrity import Watch, content_checksum_md5
from hostgrain.sources.sealed import ROW, SCHEME, key_id, new_keys, open_keys, partition_id, rewrapped, seal, unseal
from hostgrain.sources.tables import file_system, replace_text, stored

DATASET = "computer_features"
#: In clear, as they name the folders.
CLEAR = ("window_days", "anchor_day")
_COUNT = "source string, day int, record_count long"
_MANIFEST = (
    "anchor_day int, checksum_sha256 string, columns array<string>, created_at string, data_object string, data_run string, dataset string, "
    "dataset_version string, encryption_scheme string, key_id string, record_count long, schema_version string, "
    f"volume_summary struct<bronze: array<struct<{_COUNT}>>, delivered: struct<record_count: long>, event_days: array<int>, "
    f"gold: struct<anchor_day: int, record_count: long, window_days: int>, landing: array<struct<{_COUNT}>>, silver: array<struct<{_COUNT}>>>, "
    "window_days int, wrapped_key string"
)


def delivery_manifest(gold: DataFrame, secret: str, created_at: str, schema_version: str = "v1", records: DataFrame | None = None, checks: dict[tuple[int, int], tuple[int, str]] | None = None, keys: DataFrame | None = None, run: str | None = None) -> DataFrame:
    """A manifest row for each (window_days, anchor_day) of gold, columns by name.

    The digest is that of the contents, so the receiver can make it again from
    whatever files it gets. records: checksum records of the layers, for the volume
    behind each delivery (volume_summary; null without). checks: (rows, checksum) of
    each partition, where they are known; else gold is read for them. keys: the
    partitions' wrapped data keys, and run the folder of their rows (null without).
    """
    if checks is None:
        found = content_checksum_md5(gold, CLEAR)
    else:
        known = [(w, a, rows, checksum) for (w, a), (rows, checksum) in checks.items()]
        found = gold.sparkSession.createDataFrame(known, "window_days int, anchor_day int, record_count long, checksum string")
    version = F.format_string(f"{DATASET}-w%d-d%02d", F.col("window_days"), F.col("anchor_day"))
    manifest = found.select(
        "anchor_day",
        F.col("checksum").alias("checksum_sha256"),
        F.array(*[F.lit(c) for c in gold.columns]).alias("columns"),
        F.lit(created_at).alias("created_at"),
        F.concat(F.lit(f"{DATASET}/"), partition_id(F.col("window_days"), F.col("anchor_day"))).alias("data_object"),
        F.lit(run).cast("string").alias("data_run"),
        F.lit(DATASET).alias("dataset"),
        version.alias("dataset_version"),
        F.lit(SCHEME).alias("encryption_scheme"),
        F.lit(key_id(secret)).alias("key_id"),
        "record_count",
        F.lit(schema_version).alias("schema_version"),
        "window_days",
    )
    if keys is None:
        manifest = manifest.withColumn("wrapped_key", F.lit(None).cast("string"))
    else:
        manifest = manifest.join(keys.select(*CLEAR, "wrapped_key"), list(CLEAR), "left")
    if records is None:
        volume = F.lit(None).cast(StructType.fromDDL(_MANIFEST)["volume_summary"].dataType)
        with_volume = manifest.withColumn("volume_summary", volume)
    else:
        with_volume = manifest.join(nested_volume(manifest, records), list(CLEAR))
    return with_volume.select(*StructType.fromDDL(_MANIFEST).names)


def deliverable_windows(gold: DataFrame, strict: bool = True) -> DataFrame:
    """(window_days, anchor_day) to deliver; strict: only those whose sources were all present on every day."""
    windows = gold.groupBy("window_days", "anchor_day").agg(*[F.bool_and(f).alias(f) for f in FLAGS])
    if strict:
        for f in FLAGS:
            windows = windows.where(f)
    return windows.select("window_days", "anchor_day")


def deliver(gold: DataFrame, path: str, secret: str, created_at: str, records: DataFrame | None = None, checks: dict[tuple[int, int], tuple[int, str]] | None = None) -> DataFrame:
    """Delivers each (window_days, anchor_day) of gold and returns the manifests. No rows: an error.

    A partition's place is fixed: <path>/computer_features/window_days=7/anchor_day=06
    holds manifest.json (sorted keys), and in a folder that the manifest names the
    sealed rows. They are written first, and the manifest replaces the one before in
    one step; so a delivery that stops midway leaves what was delivered before, and a
    repeated one takes its place. Rows that no manifest names are then removed. checks: (rows, checksum) of each partition, where
    they are known; rows are then read once, and no manifest is written unless what
    was sealed agrees with them.
    """
    spark, rows = gold.sparkSession, gold.select(*COLUMNS)
    partitions = sorted(checks or map(tuple, rows.select(*CLEAR).distinct().collect()))  # a row per delivery
    if not partitions:
        raise ValueError("nothing to deliver")
    keys = new_keys(spark, partitions, secret)
    anchors, windows = sorted({a for _, a in checks or ()}), {str(w): f"window_days = {w}" for w in sorted({w for w, _ in checks or ()})}
    watches = [Watch("anchor_day", anchors[i : i + Watch.MOST], COLUMNS, windows) for i in range(0, len(anchors), Watch.MOST)]
    for watch in watches:
        rows = watch.on(rows)
    run = uuid.uuid4().hex
    named = seal(rows, keys).withColumns({"anchor_day": F.format_string("%02d", "anchor_day"), "run": F.lit(run)})
    named.write.mode("append").partitionBy(*CLEAR, "run").parquet(f"{path}/{DATASET}")
    if checks:
        seen = {(int(w), a): v for watch in watches for w in watch.kinds for a, v in watch.found(w).items()}
        if changed := [k for k, v in checks.items() if seen.get(k) != v]:
            raise ValueError(f"content can't be trusted: gold of {changed[:10]}")
    manifests = stored(delivery_manifest(rows, secret, created_at, records=records, checks=checks, keys=keys, run=run), "manifests")
    _write_manifests(manifests, path)
    _remove_older(spark, path, [r.data_object for r in manifests.select("data_object").collect()], run)
    return manifests


def _write_manifests(manifests: DataFrame, path: str) -> None:
    """Writes each manifest beside its rows: small files of fixed names, one for each delivered partition, as many at a time."""
    pretty = F.to_json(F.struct(*StructType.fromDDL(_MANIFEST).names), {"pretty": "true"})
    rows = manifests.select("data_object", pretty.alias("text")).collect()
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda r: replace_text(manifests.sparkSession, f"{path}/{r['data_object']}/manifest.json", r["text"]), rows))


def _remove_older(spark: SparkSession, path: str, objects: list[str], run: str) -> None:
    for at in objects:
        store, place = file_system(spark, f"{path}/{at}")
        for found in store.listStatus(place):
            if found.isDirectory() and found.getPath().getName() != f"run={run}":
                store.delete(found.getPath(), True)


def rotate(spark: SparkSession, path: str, old_secret: str, new_secret: str) -> DataFrame:
    """Wraps the data keys of all deliveries under another secret and returns the new manifests; sealed rows stay as they are.

    The old secret opens nothing from then on. A delivery that the old secret doesn't
    open fails the rotation before any manifest is written.
    """
    manifests = manifest_listing(spark, path)
    keys = rewrapped(manifests, old_secret, new_secret)
    columns = StructType.fromDDL(_MANIFEST).names
    changed = manifests.drop("wrapped_key").join(keys, list(CLEAR)).withColumn("key_id", F.lit(key_id(new_secret))).select(*columns)
    changed = stored(changed, "manifests")
    _write_manifests(changed, path)
    return changed


def _fitting(manifests: DataFrame, secret: str) -> DataFrame:
    """The data keys of manifests whose secret this is; rows of others then don't open."""
    return open_keys(manifests.where(F.col("key_id") == key_id(secret)), secret)


def manifest_listing(spark: SparkSession, path: str) -> DataFrame:
    """All manifests below path."""
    found = spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).option("pathGlobFilter", "manifest.json").option("multiLine", True)
    return found.json(f"{path}/{DATASET}")


def _rows_of(spark: SparkSession, path: str, manifests: DataFrame) -> DataFrame:
    """(window_days, anchor_day, sealed) of some deliveries: only the folders that their manifests name are opened."""
    folders = [f"{path}/{r.data_object}/run={r.data_run}" for r in manifests.select("data_object", "data_run").collect()]  # a row per delivery
    rows = spark.read.option("basePath", f"{path}/{DATASET}").parquet(*folders)
    return rows.select(*[F.col(c).cast("int").alias(c) for c in CLEAR], ROW)


def sealed_rows(spark: SparkSession, path: str) -> DataFrame:
    """The delivered rows as they are stored: the partition that they lie in, and the ciphertext."""
    return _rows_of(spark, path, manifest_listing(spark, path))


def received(spark: SparkSession, path: str, secret: str, gold_schema) -> DataFrame:
    """The delivered rows, opened; a wrong key, changed data or a moved partition raises."""
    return unseal(sealed_rows(spark, path), _fitting(manifest_listing(spark, path), secret), gold_schema)


def received_keys(spark: SparkSession, path: str, secret: str) -> DataFrame:
    """(window_days, anchor_day, data_key) of the deliveries that the secret opens."""
    return _fitting(manifest_listing(spark, path), secret)


def verified_bundle(spark: SparkSession, path: str, secret: str, first_anchor: int, last_anchor: int, window_days: int, gold_schema) -> DataFrame:
    """All deliveries of a period for one window length, as they were delivered: the union of the dailies.

    Manifests say which folders there are; only those are opened, once. Counts and
    digests are taken while the opened rows are stored, and no row is given on unless
    all partitions agree with their manifests; others are named in the error.
    """
    wanted = manifest_listing(spark, path).where((F.col("window_days") == window_days) & F.col("anchor_day").between(first_anchor, last_anchor))
    found = {r.anchor_day: r for r in wanted.select(*CLEAR, "data_object", "record_count", "checksum_sha256", "columns").collect()}  # a row per delivery
    if missing := [a for a in range(first_anchor, last_anchor + 1) if a not in found]:
        raise ValueError(f"not delivered: {', '.join(f'window_days={window_days}/anchor_day={a:02d}' for a in missing)}")
    opened = unseal(_rows_of(spark, path, wanted), _fitting(wanted, secret), gold_schema)
    anchors = sorted(found)
    watches = [Watch("anchor_day", anchors[i : i + Watch.MOST], COLUMNS) for i in range(0, len(anchors), Watch.MOST)]
    for watch in watches:
        opened = watch.on(opened)
    bundle = stored(opened, "bundle")
    seen = {a: v for watch in watches for a, v in watch.found().items()}
    if changed := [r.data_object for a, r in found.items() if seen.get(a) != (r.record_count, r.checksum_sha256) or tuple(r.columns) != COLUMNS]:
        raise ValueError(f"not as delivered: {', '.join(changed)}")
    return bundle


def delivery_acceptance(manifests: DataFrame, rows: DataFrame) -> DataFrame:
    """(window_days, anchor_day, schema_ok, count_ok, checksum_ok, accepted) of each manifest against the opened rows."""
    own = content_checksum_md5(rows, ("window_days", "anchor_day")).select(
        F.col("window_days").alias("w"), F.col("anchor_day").alias("a"), F.col("record_count").alias("found"), "checksum"
    )
    joined = manifests.join(own, (F.col("window_days") == F.col("w")) & (F.col("anchor_day") == F.col("a")), "left")
    schema_ok = F.coalesce(F.col("columns") == F.array(*[F.lit(c) for c in COLUMNS]), F.lit(False))
    count_ok = F.coalesce(F.col("record_count") == F.col("found"), F.lit(False))
    checksum_ok = F.coalesce(F.col("checksum_sha256") == F.col("checksum"), F.lit(False))
    return joined.select(
        "window_days",
        "anchor_day",
        schema_ok.alias("schema_ok"),
        count_ok.alias("count_ok"),
        checksum_ok.alias("checksum_ok"),
        (schema_ok & count_ok & checksum_ok).alias("accepted"),
    )


def redteam_sign_ins(redteam: DataFrame, auth: DataFrame) -> DataFrame:
    """The rows of auth Silver that are labelled: joined on time, user and computers."""
    labels = redteam.select(
        F.col("time").try_cast("long").alias("time"),
        F.get(F.split("user", "@"), F.lit(0)).alias("src_user_name"),
        F.get(F.split("user", "@"), F.lit(1)).alias("src_domain"),
        "src_comp",
        "dst_comp",
    ).distinct()
    keys = ["time", "src_user_name", "src_comp", "dst_comp"]
    same = [F.col(f"l.{k}") == F.col(f"a.{k}") for k in keys] + [F.col("l.src_domain").eqNullSafe(F.col("a.src_domain"))]
    return auth.alias("a").join(labels.alias("l"), same, "left_semi")


def redteam_label_join(redteam: DataFrame, auth: DataFrame) -> DataFrame:
    """(computer_id, events): labelled sign-ins per source computer."""
    return redteam_sign_ins(redteam, auth).groupBy(F.col("src_comp").alias("computer_id")).agg(F.count(F.lit(1)).alias("events"))


def redteam_labels(redteam: DataFrame, auth: DataFrame, first_anchor: int, last_anchor: int, window_days: int) -> DataFrame:
    """(window_days, anchor_day, computer_id): the source computers with a labelled sign-in within an anchor's window."""
    days = redteam_sign_ins(redteam, auth).select("day", F.col("src_comp").alias("computer_id")).distinct()  # labels are few
    anchors = F.sequence(F.greatest("day", F.lit(first_anchor)), F.least(F.col("day") + window_days - 1, F.lit(last_anchor)))
    inside = days.where(F.col("day").between(max(0, first_anchor - window_days + 1), last_anchor))
    return inside.select(F.lit(window_days).alias("window_days"), F.explode(anchors).alias("anchor_day"), "computer_id").distinct()
