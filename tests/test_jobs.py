"""Jobs over published tables: what a failure leaves, what other days keep, what is read, and late days."""

import pytest
from pyspark.sql import functions as F

from hostgrain.operators.integrity import Watch, content_checksum, content_checksum_md5
from hostgrain.plans import jobs
from hostgrain.sources import tables
from hostgrain.sources.events import SOURCES
from hostgrain.sources.published import SNAPSHOT, CommitLog, Conflict, Published

NAMES = list(SOURCES)


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def file_rows(spark, landing, name, **days):
    """Writes lines into the folders of days as a producer does: d3=['...'] is day 3."""
    for day, rows in days.items():
        tables.write_table(lines(spark, *rows).withColumn("day", F.lit(int(day[1:]))), f"{landing}/{name}", ["day"], "text")


def counts(lake, layer):
    return {(r["source"], r["day"]): r["record_count"] for r in getattr(lake, layer).records()}


@pytest.fixture
def lake(spark, tmp_path):
    return jobs.Lake(spark, f"file://{tmp_path}/lake")


@pytest.fixture
def landing(tmp_path):
    return f"file://{tmp_path}/landing"


def dns(day, computer="C1", second=5):
    return f"{day * 86_400 + second},{computer},C2"


def test_a_misfiled_row_harms_no_other_day(spark, lake, landing):
    file_rows(spark, landing, "dns", d0=[dns(0)], d1=[dns(1, f"C{i}") for i in range(3)])
    jobs.to_bronze(lake, landing, ["dns"], 0, 1, "1")
    file_rows(spark, landing, "dns", d0=[dns(0), dns(1, "C9")])
    jobs.to_bronze(lake, landing, ["dns"], 0, 0, "2")
    assert counts(lake, "bronze") == {("dns", 0): 1, ("dns", 1): 3}
    assert lake.bronze_rows("dns", lake.records("bronze", ["dns"], 1, 1).values()).count() == 3
    assert [tuple(r) for r in lake.rejected_rows().collect()] == [("dns", 0, "misfiled", dns(1, "C9"))]
    jobs.to_silver(lake, ["dns"], 0, 1, "2")  # the checksums agree


def test_a_day_without_valid_rows_fails_or_is_empty(spark, lake, landing):
    file_rows(spark, landing, "dns", d0=[dns(0)], d1=[dns(1)])
    jobs.to_bronze(lake, landing, ["dns"], 0, 1, "1")
    jobs.to_silver(lake, ["dns"], 0, 1, "1")
    file_rows(spark, landing, "dns", d1=["later,C1,C2"])
    with pytest.raises(ValueError, match="no rows of dns on day 1"):
        jobs.to_bronze(lake, landing, ["dns"], 0, 1, "2")
    assert counts(lake, "bronze") == {("dns", 0): 1, ("dns", 1): 1}
    jobs.to_bronze(lake, landing, ["dns"], 0, 1, "3", jobs.REMOVE)
    assert counts(lake, "bronze") == {("dns", 0): 1, ("dns", 1): 0}
    assert jobs.quarantine_counts(lake).collect() == [("dns", 1, 1)]
    with pytest.raises(ValueError, match="silver: no rows of dns on day 1"):
        jobs.to_silver(lake, ["dns"], 0, 1, "3")
    jobs.to_silver(lake, ["dns"], 0, 1, "3", jobs.REMOVE)
    assert counts(lake, "silver") == {("dns", 0): 1}
    file_rows(spark, landing, "dns", d1=[dns(1)])
    jobs.to_bronze(lake, landing, ["dns"], 1, 1, "4")
    assert jobs.quarantine_counts(lake).count() == 0


@pytest.mark.parametrize("step", ["stage", "publish", "_create"])
def test_a_crash_leaves_the_old_state(spark, lake, landing, monkeypatch, step):
    file_rows(spark, landing, "dns", d0=[dns(0)], d1=[dns(1)])
    jobs.to_bronze(lake, landing, ["dns"], 0, 1, "1")
    before = lake.bronze.records()
    file_rows(spark, landing, "dns", d0=[dns(0, "C7"), dns(0, "C8")])

    def crash(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        original = Published.stage
        if step == "stage":  # after the rows, before anything else
            m.setattr(Published, "stage", lambda *a: (original(*a), crash()))
        else:
            m.setattr(Published if step == "publish" else CommitLog, step, crash)
        with pytest.raises(RuntimeError, match="killed"):
            jobs.to_bronze(lake, landing, ["dns"], 0, 1, "2")
    assert lake.bronze.records() == before
    rows = lake.bronze_rows("dns", before).collect()
    assert sorted((r["day"], r["src_comp"]) for r in rows) == [(0, "C1"), (1, "C1")]
    jobs.to_silver(lake, ["dns"], 0, 1, "3")
    jobs.to_bronze(lake, landing, ["dns"], 0, 1, "4")
    assert counts(lake, "bronze") == {("dns", 0): 2, ("dns", 1): 1}
    assert lake.bronze.vacuum() == 2 and len(lake.bronze_rows("dns", lake.bronze.records()).collect()) == 3  # the first run's and the crashed one's


def test_changed_content_stops_the_next_job(spark, lake, landing):
    file_rows(spark, landing, "dns", d0=[dns(0)])
    jobs.to_bronze(lake, landing, ["dns"], 0, 0, "1")
    (record,) = lake.bronze.records()
    row = spark.createDataFrame([("5", "C1", "other")], "time string, src_comp string, resolved_comp string")
    row.write.mode("append").parquet(f"{lake.bronze._folder(record)}/outcome=accepted")
    with pytest.raises(ValueError, match="can't be trusted: bronze of dns day 0"):
        jobs.to_silver(lake, ["dns"], 0, 0, "2")
    assert lake.silver.records() == []


def test_counted_twice_is_not_changed(spark, lake, landing):
    """A repeated task's observed sums differ from the record; the content then decides."""
    file_rows(spark, landing, "dns", d0=[dns(0), dns(0, "C2")])
    jobs.to_bronze(lake, landing, ["dns"], 0, 0, "1")
    jobs._require_same(lake.records("bronze", ["dns"], 0, 0), {("dns", 0): (4, "of repeated rows")}, lake.bronze_rows, "bronze")


def test_a_watch_sees_what_is_written(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 5 - 1).cast("int").alias("day"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("v"))
    df = df.repartition(3).dropDuplicates()
    watch = Watch("day", range(-1, 6), df.columns, {"all": "true", "some": "v is not null"})
    watch.on(df).write.parquet(f"{tmp_path}/t")
    wanted = {r["day"]: (r["record_count"], r["checksum"]) for r in content_checksum_md5(df, ("day",)).collect()}
    assert watch.found() == wanted and len(wanted) == 5
    some = {r["day"]: (r["record_count"], r["checksum"]) for r in content_checksum_md5(df.where("v is not null"), ("day",)).collect()}
    assert watch.found("some") == some and some != wanted
    empty = Watch("day", [1], df.columns)
    empty.on(df.where("day = 99")).write.parquet(f"{tmp_path}/none")
    assert empty.found() == {}
    with pytest.raises(ValueError):
        Watch("day", range(100), df.columns)


def test_two_writers_lose_nothing(spark, tmp_path):
    log = CommitLog(spark, f"file://{tmp_path}/log", ("k",))
    since = log.version()
    log.commit([{"k": 1, "v": "a"}], since)
    log.commit([{"k": 2, "v": "b"}], since)  # another key: both stay
    with pytest.raises(Conflict):
        log.commit([{"k": 3}, {"k": 1, "v": "late"}], since)
    assert {k: r["v"] for k, r in log.current().items()} == {(1,): "a", (2,): "b"}
    real, raced = log._load, []

    def load():  # another writer takes the number in between
        found = real()
        if not raced:
            raced.append(CommitLog(spark, log.path, ("k",)).commit([{"k": 4, "v": "first"}]))
        return found

    log._load = load
    assert log.commit([{"k": 5, "v": "second"}]) == raced[0] + 1
    assert {r["v"] for r in real()[1].values()} == {"a", "b", "first", "second"}
    log.commit([{"k": 4, "removed": True}])
    assert (4,) not in log.current()


def test_a_reader_opens_few_files(spark, tmp_path, monkeypatch):
    from hostgrain.sources import published

    log = CommitLog(spark, f"file://{tmp_path}/log", ("k",))
    for i in range(5 * SNAPSHOT + 3):
        log.commit([{"k": i % 7, "v": i}])
    opened = []
    monkeypatch.setattr(published, "read_text", lambda s, p: opened.append(p) or tables.read_text(s, p))
    assert sorted(r["v"] for r in log.current().values()) == list(range(5 * SNAPSHOT - 4, 5 * SNAPSHOT + 3))
    assert len(opened) <= SNAPSHOT


def _days(spark, landing, first, last, skip=()):
    """Rows of all sources, a few computers a day."""
    for name in NAMES:
        rows = []
        for day in range(first, last + 1):
            for i in range(4):
                t, c = day * 86_400 + 10 * i + 1, f"C{(day * 3 + i) % 7}"
                row = {"auth": f"{t},U{i}@D,U{i + 1}@D,{c},C{i},Kerberos,Network,LogOn,{'Success' if i % 2 else 'Fail'}", "proc": f"{t},U{i}@D,{c},P{i % 2},Start", "flows": f"{t},1,{c},N1,C{i},443,6,{i},{i * 100}", "dns": f"{t},{c},C{i}"}[name]
                if (name, day, i) not in skip:
                    rows.append((row, day))
        tables.write_table(spark.createDataFrame(rows, "value string, day int"), f"{landing}/{name}", ["day"], "text")


def test_a_late_day_rebuilds_only_its_windows(spark, lake, landing, tmp_path):
    _days(spark, landing, 0, 9, {("dns", 4, 2), ("dns", 4, 3)})
    jobs.backfill(lake, landing, 0, 9, 3, "1")
    old = {r["anchor_day"]: r["run"] for r in lake.gold.records()}
    daily = {(r["source"], r["day"]): r["run"] for r in lake.daily.records()}
    assert jobs.build_gold(lake, 0, 9, 3, "2") == []  # nothing changed
    _days(spark, landing, 4, 4)
    assert jobs.late_day(lake, landing, NAMES, 4, 3, "3", 9) == [4, 5, 6]
    new = {r["anchor_day"]: r["run"] for r in lake.gold.records()}
    assert [a for a in new if new[a] != old[a]] == [4, 5, 6]
    changed = [k for k, r in {(r["source"], r["day"]): r["run"] for r in lake.daily.records()}.items() if r != daily[k]]
    assert changed == [("dns", 4)]  # the others' contents are what they were
    full = jobs.Lake(spark, f"file://{tmp_path}/full")
    wanted = jobs.backfill(full, landing, 0, 9, 3, "1")
    found = lake.gold_rows(0, 9, 3)
    sums = lambda df: sorted(map(tuple, content_checksum_md5(df, ("anchor_day",)).collect()))
    assert sums(found) == sums(wanted) and found.count() == wanted.count() > 0
    jobs.build_gold(lake, 2, 8, 5, "4")  # another length of window, from the same daily sums
    assert {(r["window_days"], r["anchor_day"]) for r in lake.gold.records()} == {(3, a) for a in range(10)} | {(5, a) for a in range(2, 9)}


def test_a_layer_is_read_once(spark, lake, landing):
    """Of all plans that a backfill and a delivery run, one for each source scans a layer, and none scans what it wrote."""
    _days(spark, landing, 0, 3)
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    jobs.backfill(lake, landing, 0, 3, 2, "1")
    jobs.deliver_windows(lake, lake.path("out"), 0, 3, 2, "key", "1")
    done = store.executionsList(before, 10_000)
    plans = [done.apply(i).physicalPlanDescription() for i in range(done.size())]
    layers = {f"{layer}/data": n for layer, n in (("bronze", 4), ("silver", 4), ("daily", 1), ("gold", 1))}
    assert {at: sum(_scans(p, at) for p in plans) for at in layers} == layers


def _scans(plan: str, at: str) -> bool:
    return any("Location" in line and f"lake/{at}" in line for line in plan.splitlines())


def test_landing_follows_the_volume(spark, tmp_path):
    small = spark.range(20_000).select(F.concat(F.col("id") % 80_000 + 1, F.lit(",C1,"), F.sha2(F.col("id").cast("string"), 256)).alias("value"))
    large = spark.range(200_000).select(F.concat(F.col("id") % 80_000 + 86_401, F.lit(",C1,"), F.sha2(F.col("id").cast("string"), 256)).alias("value"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "512k")
    try:
        tables.land(small.union(large).repartition(32).union(lines(spark, "nothing", " ,C1", "x,C1")), f"file://{tmp_path}", "dns", 0, 1)
    finally:
        spark.conf.unset(size)
    files = {day: len(list((tmp_path / f"dns/day={day}").glob("*.gz"))) for day in (0, 1)}
    assert files[1] >= 5 * files[0] > 0
    assert tables.scan_landing(spark, f"file://{tmp_path}", "dns", 0, 1).count() == 220_000
    rejects = {r["line"]: r["reason"] for r in tables.landing_rejects(spark, f"file://{tmp_path}", "dns").collect()}
    assert rejects == {"nothing": "no fields", " ,C1": "no time", "x,C1": "time is no number"}


def test_staged_rows_are_nobody_s(spark, tmp_path):
    table = Published(spark, f"file://{tmp_path}/t", ("source", "day"))
    rows = spark.createDataFrame([("a", "dns", 1), ("b", "dns", 2)], "v string, source string, day int")
    run = table.stage(rows)
    assert table.records() == [] and table.read(rows.schema, []).count() == 0
    table.publish([{"source": "dns", "day": 1, "run": run}])
    assert table.read(rows.schema, table.records()).collect() == [("a", "dns", 1)]


def test_a_watch_can_count_by_a_cheaper_digest(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 5 - 1).cast("int").alias("day"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("v"))
    for days in (range(-1, 6), range(-1, 30)):  # by their list, by their distance from the first
        watch = Watch("day", days, df.columns, {"all": "true", "some": "v is not null"}, "xxhash64")
        watch.on(df).write.mode("overwrite").parquet(f"{tmp_path}/t")
        for kind, rows in (("all", df), ("some", df.where("v is not null"))):
            wanted = {r["day"]: (r["record_count"], r["checksum"]) for r in content_checksum(rows, ("day",)).collect()}
            assert watch.found(kind) == wanted and len(wanted) == 5
    empty = Watch("day", [1], df.columns, digest="xxhash64")
    empty.on(df.where("day = 99")).write.parquet(f"{tmp_path}/none")
    assert empty.found() == {}


def test_records_of_the_older_digest_still_count(spark, lake, landing):
    file_rows(spark, landing, "dns", d0=[dns(0), dns(0, "C2")])
    jobs.to_bronze(lake, landing, ["dns"], 0, 0, "1")
    (record,) = lake.bronze.records()
    assert record["digest"] == "xxhash64"
    (md5,) = content_checksum_md5(lake.bronze_rows("dns", [record])).collect()
    old = {k: v for k, v in record.items() if k != "digest"} | {"checksum": md5["checksum"]}
    lake.bronze.publish([old])
    jobs.to_silver(lake, ["dns"], 0, 0, "2")
    assert counts(lake, "silver") == {("dns", 0): 2}
    lake.bronze.publish([old | {"checksum": "another"}])
    with pytest.raises(ValueError, match="can't be trusted: bronze of dns day 0"):
        jobs.to_silver(lake, ["dns"], 0, 0, "3")


def test_silver_shuffles_rows_once(spark, lake, landing):
    """To drop repeated rows; the write takes them as they are then, and each once."""
    file_rows(spark, landing, "dns", d0=[dns(0), dns(0), dns(0, "C2")], d1=[dns(1)])
    jobs.to_bronze(lake, landing, ["dns"], 0, 1, "1")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    jobs.to_silver(lake, ["dns"], 0, 1, "2")
    done = store.executionsList(before, 10_000)
    plans = [done.apply(i).physicalPlanDescription() for i in range(done.size())]
    (write,) = [p.split("== Initial Plan ==")[-1] for p in plans if "InsertIntoHadoopFsRelationCommand" in p]
    assert sum(line.lstrip(" :+-*").startswith("Exchange (") for line in write.splitlines()) == 1
    assert counts(lake, "silver") == {("dns", 0): 2, ("dns", 1): 1}
