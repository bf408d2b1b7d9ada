"""Every query by name, with the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostgrain.operators import contract, features, governance, integrity, metrics, scoring, watchlist
from hostgrain.plans import delivery, fixtures, jobs
from hostgrain.queries import sql
from hostgrain.sources import sealed, tables
from hostgrain.sources.events import SOURCES

ANCHOR, WINDOW = 13, 7
#: Anchors of the queries over several deliveries.
FIRST, LAST = 10, 13
SECRET = "not-a-secret: for tests"
CREATED = "2024-02-01T00:00:00Z"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def _gold(spark, d, first=ANCHOR, last=ANCHOR, n=WINDOW) -> DataFrame:
    return features.computer_features(fixtures.silver(spark, d), [first, last], n)


def _scored(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    gold = tables.stored(_gold(spark, d, FIRST, LAST), "gold")
    found = tables.stored(scoring.deviations(gold), "deviations")  # for scores and contributions
    return gold, tables.stored(scoring.anomaly_scores(gold, found), "scores"), scoring.contributions(gold, found=found)


# Bronze and Silver
for _s in SOURCES:
    _query(f"bronze_{_s}", sql.bronze(_s))(lambda spark, d, s=_s: fixtures.bronze(spark, d, s))
    _query(f"silver_{_s}", sql.silver(_s))(lambda spark, d, s=_s: SOURCES[s].to_silver(fixtures.bronze(spark, d, s)))
    _columns = ", ".join(f for f in contract.FEATURES if f.startswith(f"{_s}_"))
    _roles = {"auth": "auth_out UNION SELECT computer_id FROM auth_in", "flows": "flows_out UNION SELECT computer_id FROM flows_in"}
    _query(
        f"features_{_s}",
        f"WITH {sql.gold_with(ANCHOR, ANCHOR, WINDOW)} SELECT computer_id, {_columns} FROM gold "
        f"WHERE computer_id IN (SELECT computer_id FROM {_roles.get(_s, f'{_s}_of')})",
    )(lambda spark, d, s=_s: features.source_features(s, SOURCES[s].to_silver(fixtures.bronze(spark, d, s)), ANCHOR, WINDOW))


# Landing and tables
@_query("land_day_range", f"SELECT day, count(*) AS lines FROM ({sql.bronze('auth')}) WHERE day BETWEEN 2 AND 9 GROUP BY day")
def _land(spark, d):
    path = tables.scratch(spark, "landing")
    tables.land(fixtures.raw_lines(spark, d, "auth"), path, "auth", 2, 9)
    return spark.read.text(f"{path}/auth").groupBy("day").agg(F.count(F.lit(1)).alias("lines"))


@_query("scan_landing_csv", 'SELECT time, "user", computer, process_name, event_type FROM (' + sql.bronze("proc") + ") WHERE day BETWEEN 5 AND 8")
def _scan_landing(spark, d):
    path = tables.scratch(spark, "landing")
    tables.land(fixtures.raw_lines(spark, d, "proc"), path, "proc", 0, 29)
    return tables.scan_landing(spark, path, "proc", 5, 8)


@_query("landing_digests")
def _digests(spark, d):
    path = tables.scratch(spark, "landing")
    tables.land(fixtures.raw_lines(spark, d, "dns"), path, "dns", 0, 29)
    return tables.landing_digests(spark, path, "dns")


@_query("bronze_partition_scan", sql.bronze("flows").replace("SELECT", "SELECT * FROM (SELECT", 1) + ") WHERE day = 4")
def _bronze_scan(spark, d):
    path = tables.scratch(spark, "bronze")
    tables.write_table(fixtures.bronze(spark, d, "flows"), path, ["source", "day"])
    return tables.scan_bronze(spark, path, SOURCES["flows"], 4)


@_query("silver_window_scan", f"{sql.silver('dns')} AND day BETWEEN {ANCHOR - WINDOW + 1} AND {ANCHOR}")
def _silver_scan(spark, d):
    path = tables.scratch(spark, "silver")
    tables.write_table(SOURCES["dns"].to_silver(fixtures.bronze(spark, d, "dns")), path, ["day"])
    return tables.scan_silver(spark, path, ANCHOR, WINDOW)


@_query("gold_partition_scan", f"WITH {sql.gold_with(12, 12, WINDOW)} SELECT * FROM gold")
def _gold_scan(spark, d):
    path = tables.scratch(spark, "gold")
    tables.write_table(_gold(spark, d, 11, 12), path, ["window_days", "anchor_day"])
    return tables.scan_gold(spark, path, [12], WINDOW)


@_query("dynamic_overwrite_roundtrip", f"SELECT day, count(*) AS rows FROM ({sql.silver('auth')}) GROUP BY day")
def _overwrite(spark, d):
    path, silver = tables.scratch(spark, "silver"), SOURCES["auth"].to_silver(fixtures.bronze(spark, d, "auth"))
    tables.write_table(silver, path, ["day"])
    tables.write_table(silver.where("day between 3 and 6"), path, ["day"])  # again: nothing is doubled, nothing lost
    return spark.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("rows"))


# Features over windows
_FLAGSHIP = f"WITH {sql.gold_with(ANCHOR, ANCHOR, WINDOW)} SELECT * FROM gold"
_query("computer_features", _FLAGSHIP)(_gold)
_query("computer_features_w3", f"WITH {sql.gold_with(ANCHOR, ANCHOR, 3)} SELECT * FROM gold")(lambda spark, d: _gold(spark, d, n=3))
_query("computer_features_anchor0", f"WITH {sql.gold_with(0, 0, WINDOW)} SELECT * FROM gold")(lambda spark, d: _gold(spark, d, 0, 0))
_query("computer_features_multi_anchor", f"WITH {sql.gold_with(0, 29, WINDOW)} SELECT * FROM gold")(lambda spark, d: _gold(spark, d, 0, 29))


@_query("retraining_bundle", f"WITH {sql.gold_with(4, 8, WINDOW)} SELECT * FROM gold")
def _bundle(spark, d):
    path, gold = tables.scratch(spark, "delivery"), tables.stored(_gold(spark, d, 2, 9), "gold")
    delivery.deliver(gold, path, SECRET, CREATED)
    return delivery.verified_bundle(spark, path, SECRET, 4, 8, WINDOW, gold.schema)


def _gap(spark, d) -> dict[str, DataFrame]:
    silver = fixtures.silver(spark, d)
    return silver | {"dns": silver["dns"].where("day <> 10")}


_FLAGS = ", ".join(contract.FLAGS)
_query("computer_features_gap", f"WITH {sql.gold_with(ANCHOR, ANCHOR, WINDOW, True)} SELECT * FROM gold")(
    lambda spark, d: features.computer_features(_gap(spark, d), [ANCHOR], WINDOW)
)
_query("source_presence", f"WITH {sql.gold_with(0, 29, WINDOW, True)} SELECT * FROM flags")(
    lambda spark, d: features.source_presence(_gap(spark, d), 0, 29, WINDOW)
)
_query("deliverable_windows", f"WITH {sql.gold_with(8, 20, WINDOW, True)} SELECT DISTINCT window_days, anchor_day FROM gold WHERE source_present_auth AND source_present_proc AND source_present_flows AND source_present_dns")(
    lambda spark, d: delivery.deliverable_windows(features.computer_features(_gap(spark, d), [8, 20], WINDOW))
)
_query("active_computers", f"WITH {sql.gold_with(ANCHOR, ANCHOR, WINDOW)} SELECT computer_id FROM gold")(
    lambda spark, d: features.active_computers(fixtures.silver(spark, d), ANCHOR - WINDOW + 1, ANCHOR)
)
_query(
    "window_event_days",
    f"SELECT anchor_day, CAST(e AS INTEGER) AS event_day FROM (SELECT DISTINCT day AS anchor_day FROM ({sql.bronze('auth')})), "
    f"LATERAL (SELECT unnest(range(greatest(0, anchor_day - {WINDOW - 1}), anchor_day + 1)) AS e)",
)(lambda spark, d: features.window_days_table(fixtures.bronze(spark, d, "auth").select(F.col("day").alias("anchor_day")), WINDOW))
_query(
    "unidentified_rows",
    "SELECT 'auth' AS source, count(*) AS rows FROM (" + sql.silver("auth") + ") WHERE src_comp IS NULL OR dst_comp IS NULL"
    " UNION ALL SELECT 'proc', count(*) FROM (" + sql.silver("proc") + ") WHERE computer IS NULL"
    " UNION ALL SELECT 'flows', count(*) FROM (" + sql.silver("flows") + ") WHERE src_comp IS NULL OR dst_comp IS NULL"
    " UNION ALL SELECT 'dns', count(*) FROM (" + sql.silver("dns") + ") WHERE src_comp IS NULL",
)(lambda spark, d: features.unidentified(fixtures.silver(spark, d)))
_LABELS = f"""SELECT TRY_CAST(time AS BIGINT) AS time, split_part("user", '@', 1) AS u, CASE WHEN contains("user", '@') THEN split_part("user", '@', 2) END AS dom,
    src_comp, dst_comp FROM ({fixtures.raw_sql('redteam')})"""
_LABELLED = "a.time = r.time AND a.src_user_name = r.u AND a.src_domain IS NOT DISTINCT FROM r.dom AND a.src_comp = r.src_comp AND a.dst_comp = r.dst_comp"
_RED = f"SELECT a.src_comp AS computer_id, count(*) AS events FROM ({sql.silver('auth')}) a SEMI JOIN ({_LABELS}) r ON {_LABELLED} GROUP BY a.src_comp"
_query("redteam_label_join", _RED)(
    lambda spark, d: delivery.redteam_label_join(fixtures.raw(spark, d, "redteam"), SOURCES["auth"].to_silver(fixtures.bronze(spark, d, "auth")))
)


# Integrity and governance
_AUTH = ["time", "day", "source", "src_user_name", "src_domain", "dst_user_name", "dst_domain", "src_comp", "dst_comp", "auth_type", "logon_type", "auth_orientation", "src_user_is_machine", "dst_user_is_machine", "auth_success"]


def _auth_silver(spark, d):
    return SOURCES["auth"].to_silver(fixtures.bronze(spark, d, "auth"))


_query("content_checksum")(lambda spark, d: integrity.content_checksum(_auth_silver(spark, d)))
_query("content_checksum_md5", f"SELECT count(*) AS record_count, {sql.checksum(_AUTH)} AS checksum FROM ({sql.silver('auth')})")(
    lambda spark, d: integrity.content_checksum_md5(_auth_silver(spark, d))
)
_query("partition_checksums")(lambda spark, d: integrity.content_checksum(_auth_silver(spark, d), ("source", "day")))
_query("partition_checksums_md5", f"SELECT source, day, count(*) AS record_count, {sql.checksum(_AUTH)} AS checksum FROM ({sql.silver('auth')}) GROUP BY ALL")(
    lambda spark, d: integrity.content_checksum_md5(_auth_silver(spark, d), ("source", "day"))
)


@_query(
    "checksum_validation",
    f"""SELECT source, day, count(*) AS record_count, CASE WHEN day = 3 THEN 'missing' WHEN day = 5 THEN 'mismatch' ELSE 'ok' END AS status
        FROM ({sql.silver('auth')}) GROUP BY source, day""",
)
def _validation(spark, d):
    checks = tables.stored(integrity.content_checksum_md5(_auth_silver(spark, d), ("source", "day")), "checks")
    recorded = checks.where("day <> 3").withColumn("checksum", F.when(F.col("day") == 5, "changed").otherwise(F.col("checksum")))
    return integrity.checksum_validation(recorded, checks, ["source", "day"])


def _counts(spark, d) -> DataFrame:
    parts = [governance.layer_counts(fixtures.bronze(spark, d, s), "bronze") for s in SOURCES]
    parts += [governance.layer_counts(df, "silver") for df in fixtures.silver(spark, d).values()]
    landed = [governance.layer_counts(fixtures.bronze(spark, d, s), "landing") for s in SOURCES]
    return reduce(DataFrame.unionByName, landed + parts)


_COUNTS = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, source, day, count(*) AS record_count FROM ({f(s)}) GROUP BY source, day"
    for layer, f in (("landing", sql.bronze), ("bronze", sql.bronze), ("silver", sql.silver))
    for s in SOURCES
)
_query("layer_counts", _COUNTS)(_counts)
_query(
    "missing_partitions",
    f"SELECT s.source, CAST(d AS INTEGER) AS day FROM (VALUES {', '.join(f'({chr(39)}{s}{chr(39)})' for s in SOURCES)}) s(source), range(0, 35) r(d) "
    f"WHERE (s.source, d) NOT IN (SELECT (source, day) FROM ({_COUNTS}) WHERE NOT (source = 'dns' AND day = 10))",
)(lambda spark, d: integrity.missing_partitions(_counts(spark, d).where("not (source = 'dns' and day = 10)"), list(SOURCES), list(range(35))))


@_query(
    "governance_upsert",
    f"""SELECT layer, source, day, NULL::INTEGER AS window_days, record_count + CASE WHEN day >= 5 THEN 1 ELSE 0 END AS record_count,
        CASE WHEN day >= 5 THEN '2024-02-02' ELSE '2024-02-01' END AS created_at FROM ({_COUNTS})""",
)
def _upsert(spark, d):
    old = _counts(spark, d).withColumn("window_days", F.lit(None).cast("int")).withColumn("created_at", F.lit("2024-02-01"))
    new = old.where("day >= 5").withColumns({"record_count": F.col("record_count") + 1, "created_at": F.lit("2024-02-02")})
    return governance.upsert(old, new).select("layer", "source", "day", "window_days", "record_count", "created_at")


_query("checksum_counts", f"SELECT layer, source, day, NULL::INTEGER AS window_days, record_count FROM ({_COUNTS}) WHERE layer IN ('bronze', 'silver') AND day BETWEEN 7 AND 13")(
    lambda spark, d: governance.checksum_counts(_counts(spark, d).withColumn("window_days", F.lit(None).cast("int")), ["bronze", "silver"], 7, 13)
)
_query("lineage_rows", f"SELECT source, day, 'bronze' AS from_layer, 'silver' AS to_layer, record_count, 'v1' AS schema_version, NULL::INTEGER AS window_days FROM ({_COUNTS}) WHERE layer = 'silver'")(
    lambda spark, d: governance.lineage_rows(_counts(spark, d).where("layer = 'silver'"), "bronze", "silver")
)


def _volume(spark, d) -> DataFrame:
    gold = governance.layer_counts(_gold(spark, d).withColumns({"source": F.lit(None).cast("string"), "day": F.col("anchor_day")}), "gold")
    records = _counts(spark, d).withColumn("window_days", F.lit(None).cast("int")).unionByName(gold.withColumn("window_days", F.lit(WINDOW)))
    delivered = _gold(spark, d).count()
    return governance.volume_summary(tables.stored(records, "records"), ANCHOR, WINDOW, delivered)


_VOLUME = f"""volume AS (SELECT layer, source, day, record_count FROM ({_COUNTS}) WHERE day BETWEEN {ANCHOR - WINDOW + 1} AND {ANCHOR}
    UNION ALL SELECT 'gold', NULL, {ANCHOR}, count(*) FROM gold UNION ALL SELECT 'delivered', NULL, {ANCHOR}, count(*) FROM gold)"""
_TOTALS = """totals AS (SELECT CAST(o AS INTEGER) AS layer_order, l.layer, CAST(sum(record_count) AS BIGINT) AS record_count
    FROM (VALUES (0, 'landing'), (1, 'bronze'), (2, 'silver'), (3, 'gold'), (4, 'delivered')) l(o, layer) LEFT JOIN volume USING (layer) GROUP BY ALL)"""
_BASE = f"WITH {sql.gold_with(ANCHOR, ANCHOR, WINDOW)}, {_VOLUME}, {_TOTALS}"
_query("volume_summary", f"{_BASE} SELECT * FROM volume")(_volume)
_query("layer_totals", f"{_BASE} SELECT * FROM totals")(lambda spark, d: governance.layer_totals(_volume(spark, d)))
_query(
    "phase_deltas",
    f"{_BASE} SELECT a.layer || ' to ' || b.layer AS phase, a.record_count AS rows_before, b.record_count AS rows_after, "
    "b.record_count - a.record_count AS delta FROM totals a JOIN totals b ON b.layer_order = a.layer_order + 1",
)(lambda spark, d: governance.phase_deltas(_volume(spark, d)))


# Scores and reports
_S = f"WITH {sql.scored_with(FIRST, LAST, WINDOW)}"
_ONE = f"anchor_day = {LAST}"
_query("anomaly_scores", f"{_S} SELECT * FROM scores")(lambda spark, d: _scored(spark, d)[1])
_query("anomaly_contributions", f"{_S} SELECT * FROM drivers")(lambda spark, d: _scored(spark, d)[2])
_query("risk_levels", f"{_S} SELECT window_days, anchor_day, computer_id, risk FROM risk")(
    lambda spark, d: scoring.risk_levels(_scored(spark, d)[1]).select("window_days", "anchor_day", "computer_id", "risk")
)
_query("top_computers", f"{_S} SELECT computer_id, anomaly_score FROM scores WHERE {_ONE} ORDER BY anomaly_score DESC, computer_id LIMIT 15")(
    lambda spark, d: scoring.top_computers(_scored(spark, d)[1].where(_ONE))
)


@_query(
    "redteam_auc",
    f"""{_S}, red AS (SELECT DISTINCT a.day, a.src_comp AS computer_id FROM ({sql.silver('auth')}) a SEMI JOIN ({_LABELS}) r ON {_LABELLED}),
        hit AS (SELECT DISTINCT anchor_day, computer_id FROM red JOIN anchors ON day BETWEEN anchor_day - {WINDOW - 1} AND anchor_day),
        marked AS (SELECT window_days, anchor_day, anomaly_score, h.computer_id IS NOT NULL AS hit FROM scores s LEFT JOIN hit h USING (anchor_day, computer_id)),
        levels AS (SELECT window_days, anchor_day, anomaly_score, count(*) AS n, count(*) FILTER (hit) AS p FROM marked GROUP BY ALL),
        run AS (SELECT *, sum(n) OVER w AS upto, sum(p) OVER w AS found, sum(n) OVER d AS total, sum(p) OVER d AS hits FROM levels
            WINDOW d AS (PARTITION BY window_days, anchor_day), w AS (PARTITION BY window_days, anchor_day ORDER BY anomaly_score DESC))
        SELECT window_days, anchor_day, max(total)::BIGINT AS computers, max(hits)::BIGINT AS labelled,
            CASE WHEN max(hits) > 0 AND max(hits) < max(total) THEN round((sum(p * ((total - upto) - (hits - found) + (n - p) / 2.0::DOUBLE)) / (max(hits) * (max(total) - max(hits))))::DOUBLE, 6) END AS auc,
            CASE WHEN max(hits) > 0 THEN round((sum(p * found / upto::DOUBLE) / max(hits))::DOUBLE, 6) END AS average_precision
        FROM run GROUP BY window_days, anchor_day""",
)
def _auc(spark, d):
    labels = delivery.redteam_labels(fixtures.raw(spark, d, "redteam"), SOURCES["auth"].to_silver(fixtures.bronze(spark, d, "auth")), FIRST, LAST, WINDOW)
    return scoring.label_quality(_scored(spark, d)[1], labels)


_WATCH = """SELECT window_days, anchor_day, CAST(row_number() OVER (PARTITION BY window_days, anchor_day ORDER BY anomaly_score DESC, computer_id) AS INTEGER) AS rank,
    computer_id, label AS reason, risk, anomaly_score AS score FROM risk JOIN drivers d USING (window_days, anchor_day, computer_id) JOIN labels USING (feature)
    WHERE risk <> 'Normal' AND d.rank = 1"""
_query("watchlist", f"{_S} {_WATCH} QUALIFY rank <= 50")(lambda spark, d: watchlist.watchlist(*_scored(spark, d)[1:]))
_query("watchlist_search", f"{_S} {_WATCH} AND contains(lower(computer_id), 'c1') QUALIFY rank <= 50")(
    lambda spark, d: watchlist.watchlist(*_scored(spark, d)[1:], search=" C1 ")
)
_query("watchlist_total", f"{_S} SELECT count(*) AS total FROM risk WHERE risk = 'Medium'")(
    lambda spark, d: watchlist.watchlist_total(_scored(spark, d)[1], "medium")
)
_query("driver_frequency", f"{_S} SELECT feature, label, count(*) AS computers FROM firsts JOIN labels USING (feature) GROUP BY ALL ORDER BY computers DESC, feature LIMIT 5")(
    lambda spark, d: watchlist.driver_frequency(*_scored(spark, d)[1:])
)
_query("attention_by_family", f"{_S} SELECT family, {sql.FAMILY_LABEL} AS label, count(*) AS computers FROM (SELECT split_part(feature, '_', 1) AS family FROM firsts) GROUP BY family")(
    lambda spark, d: watchlist.attention_by_family(*_scored(spark, d)[1:])
)
_query(
    "triage_kpis",
    f"""{_S}, own AS (SELECT * FROM risk WHERE {_ONE}), theme AS (SELECT label, count(*) AS c FROM firsts JOIN labels USING (feature) WHERE {_ONE}
        GROUP BY feature, label ORDER BY c DESC, feature LIMIT 1)
        SELECT count(*) AS computers, count(*) FILTER (risk <> 'Normal') AS attention, count(*) FILTER (risk = 'High') AS high,
        count(*) FILTER (risk = 'Medium') AS medium, max(computer_id) FILTER (p = 1) AS highest_id, max(anomaly_score) AS highest_score,
        max(risk) FILTER (p = 1) AS highest_risk, (SELECT label FROM theme) AS theme_label, coalesce((SELECT c FROM theme), 0) AS theme_count FROM own""",
)(lambda spark, d: (lambda s: watchlist.triage_kpis(s[1].where(_ONE), s[2].where(_ONE)))(_scored(spark, d)))
_query("driver_rows", f"{_S} SELECT d.rank, feature, label, abs_z FROM drivers d JOIN labels USING (feature) WHERE computer_id = 'C7' AND {_ONE}")(
    lambda spark, d: scoring.driver_rows(_scored(spark, d)[2].where(_ONE), "C7")
)
_query(
    "standouts",
    f"""{_S} SELECT computer_id, '**' || computer_id || '** — ' || risk || ' risk: unusually high ' || lower(label) || '.' AS sentence
        FROM (SELECT * FROM risk WHERE {_ONE} ORDER BY anomaly_score DESC, computer_id LIMIT 5) r
        JOIN firsts f USING (window_days, anchor_day, computer_id) JOIN labels USING (feature)""",
)(lambda spark, d: (lambda s: scoring.standouts(s[1].where(_ONE), s[2].where(_ONE)))(_scored(spark, d)))

_G = f"WITH {sql.gold_with(ANCHOR, ANCHOR, WINDOW)}"
_SUMS = ", ".join(f"CAST(sum({' + '.join(c)}) AS BIGINT) AS {n}" for n, c in metrics.FIGURES.items())
_query("activity_totals", f"{_G} SELECT count(*) AS computers, {_SUMS} FROM gold")(lambda spark, d: metrics.activity_totals(_gold(spark, d)))
_query("sign_in_success_rate", f"{_G} SELECT round(1.0 - failed_sign_ins / sign_ins, 6) AS success_rate FROM (SELECT {_SUMS} FROM gold)")(
    lambda spark, d: metrics.sign_in_success_rate(_gold(spark, d))
)
_query("activity_mix", f"{_G}, t AS (SELECT {_SUMS} FROM gold) " + " UNION ALL ".join(f"SELECT '{k}' AS activity, {v} AS events FROM t" for k, v in metrics.MIX.items()))(
    lambda spark, d: metrics.activity_mix(_gold(spark, d))
)
_BYTES = " + ".join(metrics.FIGURES["network_bytes"])
_query("top_computers_by_bytes", f"{_G} SELECT computer_id, {_BYTES} AS value FROM gold WHERE {_BYTES} > 0 ORDER BY value DESC, computer_id LIMIT 8")(
    lambda spark, d: metrics.top_computers_by(_gold(spark, d), metrics.FIGURES["network_bytes"])
)
_query(
    "source_health",
    f"WITH {sql.gold_with(ANCHOR, ANCHOR, WINDOW, True)} " + " UNION ALL ".join(f"SELECT '{s}' AS source, bool_and(source_present_{s}) AS delivered FROM gold" for s in SOURCES),
)(lambda spark, d: metrics.source_health(features.computer_features(_gap(spark, d), [ANCHOR], WINDOW)))


# Deliveries
_M = f"WITH {sql.gold_with(FIRST, LAST, WINDOW)}"
_MANIFEST = f"""SELECT 'computer_features' AS dataset, 'computer_features-w{WINDOW}-d' || printf('%02d', anchor_day) AS dataset_version, 'v1' AS schema_version,
    window_days, anchor_day, count(*) AS record_count, '{",".join(contract.COLUMNS)}' AS columns, '{CREATED}' AS created_at,
    '{sealed.SCHEME}' AS encryption_scheme, '{sealed.key_id(SECRET)}' AS key_id,
    'computer_features/window_days={WINDOW}/anchor_day=' || printf('%02d', anchor_day) AS data_object FROM gold GROUP BY window_days, anchor_day"""


def _plain(manifests: DataFrame) -> DataFrame:
    return manifests.withColumn("columns", F.array_join("columns", ",")).drop("checksum_sha256", "volume_summary", "wrapped_key", "data_run")


def _delivered(spark, d) -> tuple[str, DataFrame]:
    path, gold = tables.scratch(spark, "delivery"), tables.stored(_gold(spark, d, FIRST, LAST), "gold")
    delivery.deliver(gold, path, SECRET, CREATED)
    return path, gold


_query("delivery_manifest", f"{_M} {_MANIFEST}")(lambda spark, d: _plain(delivery.delivery_manifest(_gold(spark, d, FIRST, LAST), SECRET, CREATED)))
_query("manifest_listing", f"{_M} {_MANIFEST}")(lambda spark, d: _plain(delivery.manifest_listing(spark, _delivered(spark, d)[0])))
_query("delivery_overview", f"{_M} SELECT anchor_day, window_days, count(*) AS records, 'v1' AS schema, '{CREATED}' AS created_at FROM gold GROUP BY ALL")(
    lambda spark, d: metrics.delivery_overview(delivery.manifest_listing(spark, _delivered(spark, d)[0])).drop("checksum")
)


@_query("encrypted_roundtrip", f"{_M} SELECT * FROM gold")
def _roundtrip(spark, d):
    path, gold = _delivered(spark, d)
    return delivery.received(spark, path, SECRET, gold.schema)


@_query("tamper_report", f"{_M} SELECT printf('window_days={WINDOW}/anchor_day=%02d', anchor_day) AS partition, count(*) AS rows, CASE WHEN anchor_day = 12 THEN count(*) ELSE 0 END AS unreadable FROM gold GROUP BY anchor_day")
def _tampered(spark, d):
    path, gold = _delivered(spark, d)
    changed = F.when(F.col("anchor_day") == 12, F.unhex(F.reverse(F.hex(sealed.ROW)))).otherwise(F.col(sealed.ROW))
    rows = delivery.sealed_rows(spark, path).withColumn(sealed.ROW, changed)
    return sealed.tamper_report(rows, delivery.received_keys(spark, path, SECRET), gold.columns)


@_query("rotated_roundtrip", f"{_M} SELECT * FROM gold")
def _rotated(spark, d):
    """After the secret changed, the new one opens the rows, which stayed as they were."""
    path, gold = _delivered(spark, d)
    delivery.rotate(spark, path, SECRET, f"{SECRET}, changed")
    return delivery.received(spark, path, f"{SECRET}, changed", gold.schema)


@_query("delivery_acceptance", f"{_M} SELECT window_days, anchor_day, true AS schema_ok, anchor_day <> 11 AS count_ok, anchor_day <> 11 AS checksum_ok, anchor_day <> 11 AS accepted FROM gold GROUP BY ALL")
def _acceptance(spark, d):
    path, gold = _delivered(spark, d)
    rows = delivery.received(spark, path, SECRET, gold.schema).where("anchor_day <> 11 or computer_id <> 'C7'")
    return delivery.delivery_acceptance(delivery.manifest_listing(spark, path), rows)


def _manifests(spark, d) -> DataFrame:
    """Manifests of which one lacks a column, one has another too, and one has two swapped."""
    manifest = delivery.delivery_manifest(_gold(spark, d, FIRST, LAST), SECRET, CREATED)
    swapped = [*contract.COLUMNS[:3], contract.COLUMNS[4], contract.COLUMNS[3], *contract.COLUMNS[5:]]
    changed = (
        F.when(F.col("anchor_day") == 11, F.array_remove("columns", "dns_lookup_count"))
        .when(F.col("anchor_day") == 12, F.array_append("columns", F.lit("extra")))
        .when(F.col("anchor_day") == 13, F.array(*[F.lit(c) for c in swapped]))
        .otherwise(F.col("columns"))
    )
    return manifest.withColumn("columns", changed)


_AT = contract.COLUMNS.index("dns_lookup_count")
_query(
    "schema_diff",
    f"""{_M} SELECT window_days, anchor_day, anchor_day = 10 AS ok, 35 AS expected_count, CASE anchor_day WHEN 11 THEN 34 WHEN 12 THEN 36 ELSE 35 END AS actual_count,
        CASE WHEN anchor_day = 11 THEN 'dns_lookup_count' ELSE '' END AS missing, CASE WHEN anchor_day = 12 THEN 'extra' ELSE '' END AS unexpected,
        anchor_day = 13 AS order_mismatch, CASE WHEN anchor_day = 13 THEN 3 END AS first_order_diff FROM gold GROUP BY window_days, anchor_day""",
)(lambda spark, d: contract.schema_diff(_manifests(spark, d)))
_query(
    "schema_column_status",
    f"""{_M}, m AS (SELECT DISTINCT window_days, anchor_day FROM gold), c AS (SELECT unnest({sql.CONTRACT}) AS "column", CAST(unnest(range(1, 36)) AS INTEGER) AS position)
        SELECT window_days, anchor_day, position, "column", CASE WHEN anchor_day = 11 AND "column" = 'dns_lookup_count' THEN 'missing'
            WHEN anchor_day = 11 AND position > {_AT + 1} THEN 'wrong order' WHEN anchor_day = 13 AND position IN (4, 5) THEN 'wrong order' ELSE 'ok' END AS status FROM m, c
        UNION ALL SELECT window_days, anchor_day, NULL, 'extra', 'unexpected' FROM m WHERE anchor_day = 12""",
)(lambda spark, d: contract.schema_column_status(_manifests(spark, d)))


_query("manifest_lookup", f"{_M} SELECT * FROM ({_MANIFEST}) WHERE anchor_day = 12")(
    lambda spark, d: _plain(metrics.find_manifest(delivery.manifest_listing(spark, _delivered(spark, d)[0]), WINDOW, 12))
)
_query("newest_manifest", f"{_M} SELECT * FROM ({_MANIFEST}) WHERE anchor_day = {LAST}")(
    lambda spark, d: _plain(metrics.find_manifest(delivery.manifest_listing(spark, _delivered(spark, d)[0])))
)


# Jobs from layer to layer
def _lake(spark, d, first: int, last: int, names=tuple(SOURCES)) -> tuple[jobs.Lake, str]:
    root = tables.scratch(spark, "lake")
    jobs._each(names, lambda s: tables.land(fixtures.raw_lines(spark, d, s), f"{root}/landing", s, first, last))
    return jobs.Lake(spark, root), f"{root}/landing"


#: Days of the registered jobs: all that the tables have.
DAYS = (0, 29)


@_query("stage_bronze_to_silver", f"SELECT source, day, record_count FROM ({_COUNTS}) WHERE layer = 'silver'")
def _stage(spark, d):
    lake, landing = _lake(spark, d, *DAYS)
    jobs.to_bronze(lake, landing, list(SOURCES), *DAYS, CREATED)
    return jobs.to_silver(lake, list(SOURCES), *DAYS, CREATED).select("source", "day", "record_count")


@_query("backfill_range", f"WITH {sql.gold_with(*DAYS, WINDOW)} SELECT * FROM gold")
def _backfill(spark, d):
    return jobs.backfill(*_lake(spark, d, *DAYS), *DAYS, WINDOW, CREATED)


@_query("reprocess_window", f"WITH {sql.gold_with(4, 4, 3)} SELECT * FROM gold")
def _reprocess(spark, d):
    return jobs.reprocess_window(*_lake(spark, d, *DAYS), 4, 3, CREATED)


_BAD, _MOVED, _BARE = "TRY_CAST(time AS BIGINT) % 97 = 0", "TRY_CAST(time AS BIGINT) % 89 = 0", "TRY_CAST(time AS BIGINT) % 83 = 0"
_FOLDER = f"CAST(CASE WHEN {_MOVED} THEN (day + 1) % 30 ELSE day END AS INTEGER)"


def _file_lines(spark, d, landing: str, name: str, folder: str = "day", bad: str = _BAD, only: str = "true") -> None:
    """Lands lines as a producer does that writes some times as text, or some rows into the folder of another day."""
    rows = fixtures.bronze(spark, d, name).where(only)
    fields = [F.when(F.expr(bad), F.concat(F.lit("at "), "time")).otherwise(F.col("time")), *[F.coalesce(f, F.lit("")) for f in SOURCES[name].fields[1:]]]
    tables.write_table(rows.select(F.concat_ws(",", *fields).alias("value"), F.expr(folder).alias("day")), f"{landing}/{name}", ["day"], "text")


@_query("quarantine_counts", f"SELECT source, day AS landing_day, count(*) AS rows FROM ({sql.bronze('auth')}) WHERE {_BAD} GROUP BY ALL")
def _quarantined(spark, d):
    lake = jobs.Lake(spark, tables.scratch(spark, "lake"))
    _file_lines(spark, d, lake.path("landing"), "auth")
    jobs.to_bronze(lake, lake.path("landing"), ["auth"], *DAYS, CREATED)
    return jobs.quarantine_counts(lake)


@_query(
    "misfiled_rows",
    " UNION ALL ".join(
        f"SELECT source, {_FOLDER} AS landing_day, CASE WHEN {_BAD} THEN 'undated' ELSE 'misfiled' END AS reason, count(*) AS rows FROM ({sql.bronze(s)}) WHERE {_BAD} OR {_MOVED} GROUP BY ALL"
        for s in SOURCES
    ),
)
def _misfiled(spark, d):
    """Rows that lie in the folder of another day, and rows without a day, are kept aside with their reason."""
    lake = jobs.Lake(spark, tables.scratch(spark, "lake"))
    jobs._each(SOURCES, lambda s: _file_lines(spark, d, lake.path("landing"), s, _FOLDER))
    jobs.to_bronze(lake, lake.path("landing"), list(SOURCES), *DAYS, CREATED, jobs.REMOVE)
    return lake.rejected_rows().groupBy("source", "landing_day", "reason").agg(F.count(F.lit(1)).alias("rows"))


@_query("republished_days", f"SELECT source, day, count(*) AS rows FROM ({sql.bronze('auth')}) WHERE day <> 4 AND (day <> 5 OR TRY_CAST(time AS BIGINT) % 2 = 0) GROUP BY ALL")
def _republished(spark, d):
    """Days 3 to 5 land again: the first as it was, the next without a valid row, the last with half its rows and with rows of other days."""
    lake = jobs.Lake(spark, tables.scratch(spark, "lake"))
    landing = lake.path("landing")
    _file_lines(spark, d, landing, "auth", bad="false")
    jobs.to_bronze(lake, landing, ["auth"], *DAYS, CREATED)
    again = "day in (3, 4) or day = 5 and cast(time as bigint) % 2 = 0 or day > 27"
    _file_lines(spark, d, landing, "auth", "least(day, 5)", "day = 4", again)
    jobs.to_bronze(lake, landing, ["auth"], 3, 5, CREATED, jobs.REMOVE)
    rows = lake.bronze_rows("auth", lake.records("bronze", ["auth"], *DAYS).values())
    return rows.groupBy("source", "day").agg(F.count(F.lit(1)).alias("rows"))


@_query("rebuilt_anchors", f"WITH {sql.gold_with(*DAYS, WINDOW)} SELECT anchor_day, count(*) AS computers, CAST(sum(dns_lookup_count) AS BIGINT) AS lookups, anchor_day BETWEEN 12 AND {11 + WINDOW} AS rebuilt FROM gold GROUP BY anchor_day")
def _rebuilt(spark, d):
    """Half of a day's lookups come late: only the windows that hold the day are built again."""
    lake, landing = _lake(spark, d, *DAYS, [s for s in SOURCES if s != "dns"])
    lines = fixtures.raw_lines(spark, d, "dns")
    time = F.split_part("value", F.lit(","), F.lit(1)).cast("long")
    early = lines.where((time % 2 == 0) | ~time.between(12 * 86_400 + 1, 13 * 86_400))
    tables.land(early, landing, "dns", *DAYS)
    jobs.backfill(lake, landing, *DAYS, WINDOW, CREATED)
    tables.land(lines, landing, "dns", 12, 12)
    rebuilt = jobs.late_day(lake, landing, ["dns"], 12, WINDOW, CREATED, DAYS[1])
    counts = lake.gold_rows(*DAYS, WINDOW).groupBy("anchor_day").agg(F.count(F.lit(1)).alias("computers"), F.sum("dns_lookup_count").alias("lookups"))
    return counts.withColumn("rebuilt", F.col("anchor_day").isin(rebuilt))


@_query(
    "landing_rejects",
    " UNION ALL ".join(
        f"""SELECT '{s}' AS source, CASE WHEN {_BARE} THEN 'no fields' WHEN {_MOVED} THEN 'no time' ELSE 'time is no number' END AS reason, count(*) AS lines
        FROM ({sql.bronze(s)}) WHERE {_BAD} OR {_MOVED} OR {_BARE} GROUP BY ALL"""
        for s in SOURCES
    ),
)
def _rejects(spark, d):
    """One pass lands the lines that have a day and keeps the others with their reason."""
    path = tables.scratch(spark, "landing")
    time = F.split_part("value", F.lit(","), F.lit(1))
    spoiled = (
        F.when(F.expr(_BARE), F.translate("value", ",", " "))
        .when(F.expr(_MOVED), F.concat(F.lit(" ,"), "value"))
        .when(F.expr(_BAD), F.concat(F.lit("at "), "value"))
        .otherwise(F.col("value"))
    )

    def rejected(name: str) -> DataFrame:
        tables.land(fixtures.as_read(fixtures.raw_lines(spark, d, name).withColumn("time", time).select(spoiled.alias("value"))), path, name, *DAYS)
        return tables.landing_rejects(spark, path, name)

    return reduce(DataFrame.unionByName, jobs._each(SOURCES, rejected)).groupBy("source", "reason").agg(F.count(F.lit(1)).alias("lines"))


_LISTS = {"landing": {s: SOURCES[s].fields for s in SOURCES}, "bronze": {s: (*SOURCES[s].fields, "source", "day") for s in SOURCES}}


@_query(
    "schema_registrations",
    " UNION ALL ".join(
        f"SELECT source, '{layer}' AS layer, 'v1' AS schema_version, '{','.join(names)}' AS columns FROM ({sql.bronze(s)}) GROUP BY source"
        for layer, lists in _LISTS.items()
        for s, names in lists.items()
    ),
)
def _schemas(spark, d):
    lake, landing = _lake(spark, d, *DAYS)
    jobs.to_bronze(lake, landing, list(SOURCES), *DAYS, CREATED)
    jobs.to_bronze(lake, landing, ["dns"], 3, 4, CREATED)  # again: still one record for each table
    return lake.schemas().select("source", "layer", "schema_version", F.array_join("columns", ",").alias("columns"))


_V = f"""{_M}, counts AS ({_COUNTS}), m AS (SELECT window_days, anchor_day, count(*) AS record_count FROM gold GROUP BY window_days, anchor_day)"""
_OF_DAYS = "(SELECT CAST(sum(c.record_count) AS BIGINT) FROM counts c WHERE c.layer = '{}' AND c.day BETWEEN m.anchor_day - m.window_days + 1 AND m.anchor_day)"


@_query(
    "delivery_records",
    f"""{_V} SELECT window_days, anchor_day, record_count, {_OF_DAYS.format("landing")} AS landing, {_OF_DAYS.format("bronze")} AS bronze,
        {_OF_DAYS.format("silver")} AS silver, record_count AS gold, window_days AS days, 'computer_features/window_days=' || window_days || '/anchor_day='
        || printf('%02d', anchor_day) AS data_object FROM m""",
)
def _delivery_records(spark, d):
    """A backfill is delivered twice; the manifests hold the volume behind them, the records one row for each delivery."""
    lake, landing = _lake(spark, d, *DAYS)
    jobs.backfill(lake, landing, *DAYS, WINDOW, CREATED)
    for created in (CREATED, CREATED.replace("2024-02-01", "2024-02-02")):
        jobs.deliver_windows(lake, lake.path("out"), FIRST, LAST, WINDOW, SECRET, created)
    found = delivery.manifest_listing(spark, lake.path("out")).select("window_days", "anchor_day", "created_at", "volume_summary")
    total = lambda layer: F.aggregate(f"volume_summary.{layer}.record_count", F.lit(0).cast("long"), lambda a, x: a + x).alias(layer)
    latest = lake.deliveries().join(found, ["window_days", "anchor_day", "created_at"])
    gold, days = F.col("volume_summary.gold.record_count").alias("gold"), F.size("volume_summary.event_days").alias("days")
    return latest.select("window_days", "anchor_day", "record_count", *map(total, governance.LAYERS[:3]), gold, days, "data_object")
