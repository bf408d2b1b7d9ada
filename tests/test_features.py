"""Hand-made cases: malformed input, null handling, windows, plans."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hostgrain.operators.contract import COLUMNS
from hostgrain.operators.features import ALIKE, computer_features, daily, source_presence, unidentified, window_event_days
from hostgrain.sources.events import SOURCES, source
from hostgrain.sources.tables import scan_silver, write_table


def silver(spark, name, rows):
    spec = SOURCES[name]
    return spec.to_silver(spec.to_bronze(spark.createDataFrame(rows, spec.raw_schema)))


def auth_row(time, src="U1@D", dst="U2@D", a="C1", b="C2", outcome="Success"):
    return (time, src, dst, a, b, "Kerberos", "Network", "LogOn", outcome)


@pytest.fixture
def tables(spark):
    return {
        "auth": silver(
            spark,
            "auth",
            [
                auth_row("1"),
                auth_row("1"),
                auth_row("2", outcome="fail"),
                auth_row("3", outcome="?"),
                auth_row("86401", src="C9$@D", b="C3"),
                auth_row("86402", src=None, a=None),
                auth_row("x"),
            ],
        ),
        "proc": silver(spark, "proc", [("5", "SYSTEM", "C4", "P1", "END"), ("6", "U1@D", "C1", "P1", "Start")]),
        "flows": silver(spark, "flows", [("5", "01", "C1", "N1", "C2", "443", "6", "12", "1024"), ("5", "1", "C1", "N1", "C2", "443", "6", "12", "1024")]),
        "dns": silver(spark, "dns", [("5", "C1", "C77")]),
    }


def test_raw_fields_become_typed(spark):
    rows = {r["time"]: r for r in silver(spark, "auth", [auth_row("86400"), auth_row("86401", src="SYSTEM", outcome="FAIL"), auth_row("0", src="a@b@c")]).collect()}
    assert [rows[t]["day"] for t in (0, 86400, 86401)] == [-1, 0, 1]
    assert rows[86401]["src_domain"] is None and rows[86401]["auth_success"] is False
    assert (rows[0]["src_user_name"], rows[0]["src_domain"]) == ("a", "b")


def test_unparseable_time_goes_to_quarantine(spark):
    spec = source("dns")
    bronze = spec.to_bronze(spark.createDataFrame([("x", "C1", "C2"), (None, "C1", "C2"), ("7", "C1", "C2")], spec.raw_schema))
    assert spec.quarantine(bronze).count() == 2 and spec.to_silver(bronze).count() == 1
    with pytest.raises(ValueError):
        source("mail")


def test_feature_row(tables):
    rows = {r["computer_id"]: r for r in computer_features(tables, [1], 2).collect()}
    assert set(rows) == {"C1", "C2", "C3", "C4"}  # C77 only was resolved
    one = rows["C1"]
    assert (one["auth_out_event_count"], one["auth_out_failed_count"], one["auth_out_failure_rate"]) == (4, 1, pytest.approx(1 / 3))
    assert (one["auth_out_distinct_users"], one["auth_out_distinct_human_users"]) == (2, 1)
    assert one["auth_in_event_count"] == 0 and one["auth_in_failure_rate"] is None
    assert one["flows_out_count_distinct"] == 1 and one["flows_out_anonymized_port_count_distinct"] == 1  # 01 and 1 are equal
    assert rows["C2"]["flows_in_anonymized_port_count_distinct"] == 0 and rows["C2"]["auth_in_event_count"] == 4
    assert rows["C4"]["proc_start_count"] == 0 and rows["C4"]["proc_distinct_users"] == 1
    assert one["source_present_auth"] and not one["source_present_proc"]
    assert list(one.asDict()) == list(COLUMNS)
    assert {r["source"]: r["rows"] for r in unidentified(tables).collect()}["auth"] == 1


def test_many_anchors_equal_one_by_one(tables):
    together = {(r["computer_id"], r["anchor_day"]): r for r in computer_features(tables, [0, 3], 2).collect()}
    alone = [r for a in range(4) for r in computer_features(tables, [a], 2).collect()]
    assert len(alone) == len(together) and all(together[r["computer_id"], r["anchor_day"]] == r for r in alone)


def test_changes_of_windows_do_not_grow_with_them(spark):
    """What stands between the daily table and the result has two rows for a day at most, however long windows are."""
    from hostgrain.operators.features import window_changes

    rows = [(str(d * 86_400 + i + 1), f"C{i % 5}", f"C{(d * i) % 7}") for d in range(60) for i in range(20)]
    days = daily({"dns": silver(spark, "dns", rows)})
    entries = days.count()
    sizes = {n: window_changes(days, 0, 59, n)[0].count() for n in (1, 7, 30)}
    assert sizes[30] <= sizes[7] <= sizes[1] <= 2 * entries
    for n in (1, 7, 30):
        changes, _ = window_changes(days, 0, 59, n)
        assert changes.where("anchor_day > 59 or anchor_day < 0").count() == 0
    plan = window_changes(days, 0, 59, 30)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence" not in plan


def test_windows_against_plain_python(spark):
    """Values that come, stay, go and come again; windows clipped at either end."""
    import random

    rng = random.Random(3)
    events = sorted({(rng.choice((0, 1, 2, 3, 9, 10, 17, 18, 25)), rng.choice("AB"), rng.choice("xyz")) for _ in range(60)})
    found = silver(spark, "dns", [(str(d * 86_400 + 1), c, v) for d, c, v in events])
    empty = {n: silver(spark, n, []) for n in SOURCES}
    for first, last, n in ((0, 29, 7), (0, 29, 1), (5, 20, 8), (12, 12, 3), (18, 24, 30)):
        wanted = {}
        for a in range(first, last + 1):
            for d, c, v in events:
                if max(0, a - n + 1) <= d <= a:
                    wanted.setdefault((a, c), []).append(v)
        rows = computer_features(empty | {"dns": found}, range(first, last + 1), n).collect()
        got = {(r["anchor_day"], r["computer_id"]): (r["dns_lookup_count"], r["dns_distinct_resolved_hosts"]) for r in rows}
        assert got == {k: (len(v), len(set(v))) for k, v in wanted.items()}


def test_windows_are_clipped_and_checked():
    assert window_event_days(0, 7) == [0] and window_event_days(3, 2) == [2, 3]
    for anchor, window in ((-1, 7), (3, 0)):
        with pytest.raises(ValueError):
            window_event_days(anchor, window)


def test_presence_needs_every_day(tables):
    flags = {r["anchor_day"]: r["source_present_auth"] for r in source_presence(tables, 0, 2, 2).collect()}
    assert flags == {0: True, 1: True, 2: False}


def test_empty_sources(spark):
    empty = {n: silver(spark, n, []) for n in SOURCES}
    assert computer_features(empty, [3], 7).count() == 0


def test_only_the_window_is_read(spark, tables, tmp_path):
    path = f"file://{tmp_path}/silver"
    write_table(tables["auth"], path, ["day"])
    write_table(tables["auth"].where("day = 1"), path, ["day"])
    assert spark.read.parquet(path).count() == tables["auth"].count()
    plan = scan_silver(spark, path, 1, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_raw_rows_are_read_once_and_shuffle_partial_sums(spark, tmp_path):
    raw = {}
    for name, spec in SOURCES.items():
        spark.createDataFrame([], spec.raw_schema).write.parquet(f"{tmp_path}/{name}")
        raw[name] = spec.to_silver(spec.to_bronze(spark.read.parquet(f"{tmp_path}/{name}")))
    plan = daily(raw, 3, 9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(SOURCES) and plan.count("Exchange hashpartitioning") == 2 * len(SOURCES)
    assert "partial_sum" in plan and "Python" not in plan
    plan = computer_features(raw, [9], 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3 and str(tmp_path) not in plan  # counts, values, presence: all from the stored days


@pytest.mark.parametrize("values", [[], [5], [1, 1], [3, 1, 2], [0, 0, 0, 7], [1e9, 2, 2.0001, 2.0002, 7, 2], list(range(1000))])
def test_medians_are_exact(spark, values):
    import statistics

    from hostgrain.operators.scoring import _medians

    rows = [(g, float(v), 1) for g in ("a", "b") for v in (values if g == "a" else values[::2])]
    counted = spark.createDataFrame(rows, "g string, x double, n long").groupBy("g", "x").agg(F.sum("n").alias("n"))
    found = {r["g"]: r["median"] for r in _medians(counted, ["g"], "x").collect()}
    assert found == {g: statistics.median(v) for g, v in (("a", values), ("b", values[::2])) if v}


def test_scores_of_a_single_row_are_zero_and_high(spark, tables):
    from hostgrain.operators.scoring import anomaly_scores, risk_levels

    one = computer_features(tables, [1], 2).where("computer_id = 'C1'")
    row = risk_levels(anomaly_scores(one)).collect()[0]
    assert row["anomaly_score"] == 0 and row["risk"] == "High"


def test_risk_shares(spark):
    from hostgrain.operators.scoring import risk_levels

    scores = spark.range(1, 101).select(F.lit(7).alias("window_days"), F.lit(1).alias("anchor_day"), F.concat(F.lit("C"), "id").alias("computer_id"), F.col("id").cast("double").alias("anomaly_score"))
    levels = {r["risk"]: r["count"] for r in risk_levels(scores).groupBy("risk").count().collect()}
    assert levels == {"High": 1, "Medium": 4, "Normal": 95}
    places = risk_levels(scores).orderBy(F.desc("anomaly_score")).collect()
    assert [r["place"] for r in places] == list(range(1, 101))
    tied = {r["risk"]: r["count"] for r in risk_levels(scores.withColumn("anomaly_score", F.lit(1.0))).groupBy("risk").count().collect()}
    assert tied == levels


def test_checksums(spark):
    from hostgrain.operators.integrity import content_checksum, content_checksum_md5

    for digest in (content_checksum, content_checksum_md5):
        of = lambda rows, schema="id long, v string": digest(spark.createDataFrame(rows, schema)).collect()[0]["checksum"]  # noqa: E731, B023
        base = of([(1, "a"), (2, None)])
        assert base == of([(2, None), (1, "a")])
        assert base not in (of([(1, "a"), (2, "")]), of([(1, "a"), (2, None), (2, None)]), of([(1, "a"), (2, None)], "id long, w string"))


def test_xxhash_checksums_against_another_implementation(spark):
    """content_checksum() by Python's xxhash: DuckDB has no such hash to compare with."""
    import hashlib

    import xxhash

    from hostgrain.operators.integrity import content_checksum

    rows = [("a", 1, None), ("a", 2, "é"), ("b", 3, ""), ("b", 3, ""), ("b", None, "x\x1fy")]
    df = spark.createDataFrame(rows, "g string, n long, v string")

    def wanted(own):
        texts = ["\x1f".join("\x00" if x is None else str(x) for x in r) for r in own]  # columns by name: g, n, v
        total = sum((h - (1 << 64) if (h := xxhash.xxh64_intdigest(t.encode(), seed=42)) >> 63 else h) + (1 << 63) for t in texts)
        return len(own), hashlib.sha256(f"g,n,v|{len(own)}|{total}".encode()).hexdigest()

    assert [tuple(r) for r in content_checksum(df).collect()] == [wanted(rows)]
    by = {r["g"]: (r["record_count"], r["checksum"]) for r in content_checksum(df, ("g",)).collect()}
    assert by == {g: wanted([r for r in rows if r[0] == g]) for g in "ab"}


def test_digests_of_landed_files(spark, tmp_path):
    import hashlib

    from hostgrain.sources.tables import land, landing_digests, landing_rejects

    lines = spark.createDataFrame([(f"{t},C{t % 5},C1",) for t in range(1, 200_000, 7_000)] + [("x,C1,C2",), ("no comma",)], "value string")
    land(lines, f"file://{tmp_path}", "dns", 0, 9)
    assert [tuple(r) for r in landing_rejects(spark, f"file://{tmp_path}", "dns").orderBy("line").collect()] == [("dns", "no fields", "no comma"), ("dns", "time is no number", "x,C1,C2")]
    wanted = {}
    for folder in (tmp_path / "dns").glob("day=[0-9]*"):
        each = sorted(hashlib.sha256(f.read_bytes()).hexdigest() for f in folder.glob("*.gz"))
        wanted[int(folder.name[4:])] = (len(each), hashlib.sha256(",".join(each).encode()).hexdigest())
    assert {r["day"]: (r["files"], r["sha256"]) for r in landing_digests(spark, f"file://{tmp_path}", "dns").collect()} == wanted and len(wanted) == 3


def test_a_source_without_rows_fails_before_anything_is_published(spark, tmp_path):
    from hostgrain.plans.jobs import Lake, quarantine_counts, to_bronze, to_silver
    from hostgrain.sources.tables import land

    lake, landing = Lake(spark, f"file://{tmp_path}/lake"), f"file://{tmp_path}/landing"
    land(spark.createDataFrame([("5,C1,C2",), ("90000,C1,C3",)], "value string"), landing, "dns", 0, 1)
    land(spark.createDataFrame([("5,U1@D,C1,P1,Start",)], "value string"), landing, "proc", 0, 1)
    to_bronze(lake, landing, ["dns", "proc"], 0, 0, "2024-01-01")
    with pytest.raises(ValueError, match="no rows of proc on day 1"):
        to_bronze(lake, landing, ["dns", "proc"], 1, 1, "2024-01-02")
    assert {(r["source"], r["day"]) for r in lake.bronze.records()} == {("dns", 0), ("proc", 0)}
    folder = tmp_path / "landing/dns/day=1"
    (folder / "more.txt").write_text("later,C1,C2\n90001,C9,C2\n")
    to_bronze(lake, landing, ["dns"], 0, 1, "2024-01-03")
    assert [tuple(r) for r in quarantine_counts(lake).collect()] == [("dns", 1, 1)]
    (folder / "more.txt").unlink()
    to_bronze(lake, landing, ["dns"], 0, 1, "2024-01-04")
    assert quarantine_counts(lake).count() == 0
    checks = {(r["layer"], r["source"], r["day"]): r["record_count"] for r in lake.checksums().collect()}
    assert checks == {(layer, s, day): 1 for layer in ("landing", "bronze") for s, day in (("dns", 0), ("dns", 1), ("proc", 0))}
    assert lake.checksums(1, 1).count() == 2
    to_silver(lake, ["dns"], 0, 1, "2024-01-04")


def test_wrong_key_and_gaps_raise(spark, tables, tmp_path):
    from hostgrain.plans.delivery import deliver, received, rotate, verified_bundle
    from hostgrain.plans.jobs import Lake, reprocess_window
    from hostgrain.sources.tables import EmptyRange, land

    gold = computer_features(tables, [1], 2)
    path = f"file://{tmp_path}/out"
    deliver(gold, path, "one", "2024-01-01")
    assert sorted(received(spark, path, "one", gold.schema).collect()) == sorted(gold.collect())
    with pytest.raises(Exception, match="(?i)aes|crypt|tag"):
        received(spark, path, "two", gold.schema).collect()
    before = {f.name: f.read_bytes() for f in (tmp_path / "out").rglob("*.parquet")}
    rotate(spark, path, "one", "new")
    assert before == {f.name: f.read_bytes() for f in (tmp_path / "out").rglob("*.parquet")}
    assert sorted(received(spark, path, "new", gold.schema).collect()) == sorted(gold.collect())
    with pytest.raises(Exception, match="(?i)aes|crypt|tag"):
        received(spark, path, "one", gold.schema).collect()
    with pytest.raises(Exception, match="(?i)aes|crypt|tag"):
        rotate(spark, path, "one", "other")
    assert sorted(received(spark, path, "new", gold.schema).collect()) == sorted(gold.collect())
    rotate(spark, path, "new", "one")
    assert verified_bundle(spark, path, "one", 1, 1, 2, gold.schema).count() == gold.count()
    with pytest.raises(ValueError, match="not delivered: window_days=2/anchor_day=02"):
        verified_bundle(spark, path, "one", 1, 2, 2, gold.schema)
    part = next((tmp_path / "out").rglob("*.parquet"))
    kept, crc = part.read_bytes(), part.with_name(f".{part.name}.crc")
    twice = pd.concat([pd.read_parquet(part)] * 2)
    crc.unlink()
    twice.to_parquet(part)
    with pytest.raises(ValueError, match="not as delivered: computer_features/window_days=2/anchor_day=01"):
        verified_bundle(spark, path, "one", 1, 1, 2, gold.schema)
    part.write_bytes(kept)
    folder = tmp_path / "out/computer_features/window_days=2"
    assert '"record_count" : 4' in (folder / "anchor_day=01/manifest.json").read_text()
    (folder / "anchor_day=01").rename(folder / "anchor_day=05")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):  # a partition moved elsewhere
        received(spark, path, "one", gold.schema).collect()
    manifest = folder / "anchor_day=05/manifest.json"
    manifest.write_text(manifest.read_text().replace("anchor_day=01", "anchor_day=05"))
    (folder / "anchor_day=05/.manifest.json.crc").unlink()
    with pytest.raises(Exception, match="(?i)aes|crypt|tag"):  # and its manifest made to fit
        received(spark, path, "one", gold.schema).collect()
    lines = spark.createDataFrame([("5,C1,C2",), ("nothing",), (",C1,C2",)], "value string")
    for n in SOURCES:
        land(lines, f"file://{tmp_path}/landing", n, 0, 3)
    with pytest.raises(EmptyRange):
        land(lines, f"file://{tmp_path}/landing", "dns", 4, 5)
    with pytest.raises(ValueError, match="not landed: auth day 1"):
        reprocess_window(Lake(spark, f"file://{tmp_path}/lake"), f"file://{tmp_path}/landing", 1, 2, "2024-01-01")


def test_a_delivery_that_stops_midway(spark, tables, tmp_path, monkeypatch):
    """What was delivered before stays readable until the new manifest is there; then its rows are gone."""
    from hostgrain.plans import delivery

    gold, path = computer_features(tables, [0, 1], 2), f"file://{tmp_path}/out"
    delivery.deliver(gold, path, "one", "2024-01-01")
    before = sorted(delivery.received(spark, path, "one", gold.schema).collect())
    changed = gold.where("computer_id <> 'C4'")
    with monkeypatch.context() as m:
        m.setattr(delivery, "_write_manifests", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            delivery.deliver(changed, path, "one", "2024-01-02")
    assert sorted(delivery.received(spark, path, "one", gold.schema).collect()) == before
    assert delivery.verified_bundle(spark, path, "one", 0, 1, 2, gold.schema).count() == len(before)
    delivery.deliver(changed, path, "one", "2024-01-03")
    assert sorted(delivery.received(spark, path, "one", gold.schema).collect()) == sorted(changed.collect())
    assert len(list(tmp_path.glob("out/computer_features/*/*/run=*"))) == 2


def test_quality_of_scores_by_labels(spark):
    """Against all pairs and all thresholds, with ties, and without one of the sorts."""
    import random

    from hostgrain.operators.scoring import label_quality

    rng = random.Random(11)
    rows, labels, wanted = [], [], {}
    for anchor, share in ((1, 0.2), (2, 0.5), (3, 0.0), (4, 1.0)):
        own = [(f"C{i}", float(rng.randrange(12)), rng.random() < share) for i in range(60)]
        rows += [(7, anchor, c, s) for c, s, _ in own]
        labels += [(7, anchor, c) for c, _, hit in own if hit] * 2 + [(7, anchor, "unknown")]
        good, bad = [s for _, s, hit in own if hit], [s for _, s, hit in own if not hit]
        auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) if good and bad else None
        ap = None
        if good:
            ap = sum(sum(g == t for g in good) / len(good) * sum(g >= t for g in good) / sum(s >= t for s in good + bad) for t in set(good))
        wanted[anchor] = (60, len(good), auc and round(auc, 6), ap and round(ap, 6))
    scores = spark.createDataFrame(rows, "window_days int, anchor_day int, computer_id string, anomaly_score double")
    found = label_quality(scores, spark.createDataFrame(labels, "window_days int, anchor_day int, computer_id string")).collect()
    assert {r["anchor_day"]: tuple(r)[2:] for r in found} == wanted


def test_alike_flows_are_summed_up_before_they_become_entries(spark):
    """The same daily sums and values, also without a computer; entries are made of the combinations, not of the events."""
    spec = source("flows")
    rows = [(str(86_400 * (i % 2) + i + 1), "1", [None, "C1", "C2"][i % 3], "N1" if i % 5 else "80", f"C{i % 2}", "443", "6", str(i) if i % 7 else "x", "10") for i in range(60)]
    silver = spec.to_silver(spec.to_bronze(spark.createDataFrame(rows, spec.raw_schema)))
    found = daily({"flows": silver}, alike=ALIKE)
    tree = found._jdf.queryExecution().optimizedPlan().toString()
    assert tree[tree.index("Generate") :].count("Aggregate") == 2  # below: these sums, and Silver's distinct rows
    own = sorted(map(str, found.collect()))
    plain = daily({"flows": silver})
    assert sorted(map(str, plain.select(*found.columns).collect())) == own and len(own) > 10
