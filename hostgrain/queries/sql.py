"""DuckDB SQL for the tables of each layer, written as plain joins and aggregates over windows of days."""

from __future__ import annotations

from hostgrain.functions.labels import FAMILIES, LABELS
from hostgrain.operators.contract import COLUMNS, FEATURES
from hostgrain.plans.fixtures import raw_sql
from hostgrain.sources.events import SOURCES


def _day(t: str = "time") -> str:
    return f"CAST(floor((TRY_CAST({t} AS BIGINT) - 1) / 86400.0) AS INTEGER)"


def _name(u: str) -> str:
    return f"split_part({u}, '@', 1)"


def _domain(u: str) -> str:
    return f"CASE WHEN contains({u}, '@') THEN split_part({u}, '@', 2) END"


def bronze(name: str) -> str:
    fields = ", ".join(f'"{f}"' for f in SOURCES[name].fields)
    return f"SELECT {fields}, '{name}' AS source, {_day()} AS day FROM ({raw_sql(name)})"


_SILVER = {
    "auth": f"""{_name("src_user")} AS src_user_name, {_domain("src_user")} AS src_domain, {_name("dst_user")} AS dst_user_name,
        {_domain("dst_user")} AS dst_domain, src_comp, dst_comp, auth_type, logon_type, auth_orientation,
        {_name("src_user")} LIKE '%$' AS src_user_is_machine, {_name("dst_user")} LIKE '%$' AS dst_user_is_machine,
        CASE lower(success) WHEN 'success' THEN true WHEN 'fail' THEN false END AS auth_success""",
    "proc": f"""{_name('"user"')} AS user_name, {_domain('"user"')} AS domain, {_name('"user"')} LIKE '%$' AS user_is_machine,
        computer, process_name, event_type""",
    "flows": """TRY_CAST(duration AS BIGINT) AS duration, src_comp, src_port, dst_comp, dst_port, protocol,
        TRY_CAST(packet_count AS BIGINT) AS packet_count, TRY_CAST(byte_count AS BIGINT) AS byte_count""",
    "dns": "src_comp, resolved_comp",
}


def silver(name: str) -> str:
    return f"SELECT DISTINCT TRY_CAST(time AS BIGINT) AS time, day, source, {_SILVER[name]} FROM ({bronze(name)}) WHERE day IS NOT NULL"


def _role(alias: str, source: str, computer: str, measures: str, n: int) -> str:
    return f"""{alias} AS (SELECT anchor_day, {computer} AS computer_id, {measures}
        FROM anchors JOIN {source} ON day BETWEEN anchor_day - {n - 1} AND anchor_day WHERE {computer} IS NOT NULL GROUP BY ALL)"""


def _auth(role: str, own: str, other: str, peers: str) -> str:
    return f"""count(*) AS auth_{role}_event_count, count(DISTINCT {other}_comp) AS auth_{role}_distinct_{peers},
        count(DISTINCT {own}_user_name) AS auth_{role}_distinct_users,
        count(DISTINCT CASE WHEN NOT {own}_user_is_machine THEN {own}_user_name END) AS auth_{role}_distinct_human_users,
        count(*) FILTER (auth_success = false) AS auth_{role}_failed_count,
        CASE WHEN count(auth_success) > 0 THEN count(*) FILTER (auth_success = false) / count(auth_success) END AS auth_{role}_failure_rate"""


def _flows(role: str, own: str, other: str, peers: str) -> str:
    return f"""count(*) AS flows_{role}_count_distinct, count(DISTINCT {other}_comp) AS flows_{role}_distinct_{peers},
        CAST(sum(byte_count) AS BIGINT) AS flows_{role}_bytes_sum_distinct, CAST(sum(packet_count) AS BIGINT) AS flows_{role}_packets_sum_distinct,
        count(*) FILTER (NOT regexp_matches({own}_port, '^[0-9]+$')) AS flows_{role}_anonymized_port_count_distinct"""


def gold_with(first: int, last: int, n: int, dns_gap: bool = False) -> str:
    """Common tables up to `gold`, without the word WITH."""
    dns = silver("dns") + (" AND day <> 10" if dns_gap else "")
    parts = [
        f"anchors AS (SELECT CAST(a AS INTEGER) AS anchor_day FROM range({first}, {last + 1}) r(a))",
        *[f"{s} AS ({dns if s == 'dns' else silver(s)})" for s in SOURCES],
        _role("auth_out", "auth", "src_comp", _auth("out", "src", "dst", "targets"), n),
        _role("auth_in", "auth", "dst_comp", _auth("in", "dst", "src", "sources"), n),
        _role("flows_out", "flows", "src_comp", _flows("out", "src", "dst", "targets"), n),
        _role("flows_in", "flows", "dst_comp", _flows("in", "dst", "src", "sources"), n),
        _role(
            "proc_of",
            "proc",
            "computer",
            """count(*) FILTER (lower(event_type) = 'start') AS proc_start_count, count(DISTINCT process_name) AS proc_distinct_process_names,
            count(DISTINCT user_name) AS proc_distinct_users, count(DISTINCT CASE WHEN NOT user_is_machine THEN user_name END) AS proc_distinct_human_users""",
            n,
        ),
        _role("dns_of", "dns", "src_comp", "count(*) AS dns_lookup_count, count(DISTINCT resolved_comp) AS dns_distinct_resolved_hosts", n),
    ]
    roles = ("auth_out", "auth_in", "proc_of", "flows_out", "flows_in", "dns_of")
    parts.append("ids AS (" + " UNION ".join(f"SELECT anchor_day, computer_id FROM {r}" for r in roles) + ")")
    flags = ", ".join(
        f"""(SELECT count(DISTINCT day) FROM {s} WHERE day BETWEEN anchor_day - {n - 1} AND anchor_day) = least({n}, anchor_day + 1) AS source_present_{s}"""
        for s in SOURCES
    )
    parts.append(f"flags AS (SELECT anchor_day, {flags} FROM anchors)")
    features = ", ".join(f if f.endswith("_rate") else f"coalesce({f}, 0) AS {f}" for f in FEATURES)
    joins = " ".join(f"LEFT JOIN {r} USING (anchor_day, computer_id)" for r in roles)
    parts.append(
        f"gold AS (SELECT computer_id, anchor_day, {n} AS window_days, {features}, source_present_auth, source_present_proc, "
        f"source_present_flows, source_present_dns FROM ids {joins} JOIN flags USING (anchor_day))"
    )
    return ",\n".join(parts)


def scored_with(first: int, last: int, n: int) -> str:
    """Common tables up to `scores`, `drivers`, `risk` and `labels`, without the word WITH."""
    values = ", ".join(f"('{f}', {i}, CAST({f} AS DOUBLE))" for i, f in enumerate(FEATURES))
    labels = ", ".join(f"('{k}', '{v}')" for k, v in LABELS.items())
    return f"""{gold_with(first, last, n)},
    cells AS (SELECT window_days, anchor_day, computer_id, feature, position, ln(1 + greatest(v, 0)) AS x
        FROM gold, LATERAL (VALUES {values}) u(feature, position, v) WHERE v IS NOT NULL),
    mid AS (SELECT window_days, anchor_day, feature, median(x) AS m, stddev_samp(x) AS sd FROM cells GROUP BY ALL),
    mad AS (SELECT window_days, anchor_day, feature, m, sd, median(abs(x - m)) AS d FROM cells JOIN mid USING (window_days, anchor_day, feature) GROUP BY ALL),
    z AS (SELECT window_days, anchor_day, computer_id, feature, position,
        abs((x - m) / CASE WHEN d > 0 THEN 1.4826 * d WHEN sd < 1e-12 THEN 1 ELSE sd END) AS abs_z
        FROM cells JOIN mad USING (window_days, anchor_day, feature)),
    scores AS (SELECT g.window_days, g.anchor_day, g.computer_id, round(coalesce(avg(abs_z), 0), 6) AS anomaly_score
        FROM gold g LEFT JOIN z USING (window_days, anchor_day, computer_id) GROUP BY ALL),
    drivers AS (SELECT window_days, anchor_day, computer_id, feature, round(abs_z, 6) AS abs_z,
        CAST(row_number() OVER (PARTITION BY window_days, anchor_day, computer_id ORDER BY round(abs_z, 6) DESC, position) AS INTEGER) AS rank
        FROM z WHERE abs_z IS NOT NULL QUALIFY rank <= 5),
    placed AS (SELECT *, row_number() OVER (PARTITION BY window_days, anchor_day ORDER BY anomaly_score DESC, computer_id) AS p,
        count(*) OVER (PARTITION BY window_days, anchor_day) AS n FROM scores),
    risk AS (SELECT window_days, anchor_day, computer_id, anomaly_score, p,
        CASE WHEN p <= greatest(1, floor(n * 0.01::DOUBLE)) THEN 'High'
             WHEN p <= greatest(1, floor(n * 0.01::DOUBLE), floor(n * 0.05::DOUBLE)) THEN 'Medium' ELSE 'Normal' END AS risk FROM placed),
    labels AS (SELECT * FROM (VALUES {labels}) l(feature, label)),
    firsts AS (SELECT d.* FROM drivers d JOIN risk r USING (window_days, anchor_day, computer_id) WHERE d.rank = 1 AND r.risk <> 'Normal')"""


def row_text(columns: list[str]) -> str:
    return "concat_ws(chr(31), " + ", ".join(f'coalesce(CAST("{c}" AS VARCHAR), chr(0))' for c in sorted(columns)) + ")"


def checksum(columns: list[str]) -> str:
    """The digest over a group, as an aggregate expression."""
    lane = f"CAST('0x' || substr(md5({row_text(columns)}), 1, 15) AS BIGINT)"
    return f"sha256(concat_ws('|', '{','.join(sorted(columns))}', CAST(count(*) AS VARCHAR), CAST(coalesce(sum({lane}), 0) AS VARCHAR)))"


FAMILY_LABEL = "CASE family " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FAMILIES.items()) + " END"
CONTRACT = "[" + ", ".join(f"'{c}'" for c in COLUMNS) + "]"
