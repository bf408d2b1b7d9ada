"""Raw event logs made from the star-schema tables: the same SQL in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hostgrain.sources.events import SOURCES

_SPARK_SECONDS = "timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) + 1"
_DUCK_SECONDS = "date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts) + 1"


def _user(user: str, event: str) -> str:
    return f"""CASE WHEN ({event}) % 11 = 0 THEN 'SYSTEM'
        WHEN ({event}) % 4 = 0 THEN 'C' || CAST(({user}) % 97 AS STRING) || '$@Dom' || CAST(({user}) % 3 AS STRING)
        ELSE 'U' || CAST(({user}) AS STRING) || '@Dom' || CAST(({user}) % 3 AS STRING) END"""


def _twice(table: str, condition: str) -> str:
    return f"(SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE {condition})"


def _port(number: str) -> str:
    return f"CASE WHEN ({number}) % 3 = 0 THEN '443' WHEN ({number}) % 3 = 1 THEN '80' ELSE 'N' || CAST(l_partkey % 50 AS STRING) END"


RAW_SQL = {
    "auth": f"""
        SELECT CAST({{seconds}} AS STRING) AS time, {_user("user_id", "event_id")} AS src_user,
               {_user("user_id + 1", "event_id + 1")} AS dst_user,
               'C' || CAST((user_id * 7 + event_id) % 97 AS STRING) AS src_comp,
               'C' || CAST((user_id * 13 + event_id * 3 + 1) % 97 AS STRING) AS dst_comp,
               CASE event_id % 3 WHEN 0 THEN 'Kerberos' WHEN 1 THEN 'NTLM' ELSE 'Negotiate' END AS auth_type,
               CASE event_id % 4 WHEN 0 THEN 'Network' WHEN 1 THEN 'Interactive' WHEN 2 THEN 'Service' ELSE 'Batch' END AS logon_type,
               CASE WHEN event_id % 2 = 0 THEN 'LogOn' ELSE 'LogOff' END AS auth_orientation,
               CASE event_type WHEN 'error' THEN 'Fail' WHEN 'signup' THEN '?' ELSE 'Success' END AS success
        FROM {_twice("{events}", "event_id % 10 = 0")} e""",
    "proc": f"""
        SELECT CAST({{seconds}} AS STRING) AS time, {_user("user_id", "event_id")} AS user,
               'C' || CAST(user_id % 97 AS STRING) AS computer, 'P' || CAST(event_id % 23 AS STRING) AS process_name,
               CASE WHEN event_id % 2 = 0 THEN 'Start' ELSE 'End' END AS event_type
        FROM {_twice("{events}", "event_id % 30 = 0")} e WHERE event_id % 3 = 0""",
    "flows": f"""
        SELECT CAST((l_orderkey % 30) * 86400 + 1 + (l_orderkey * 131 + l_linenumber * 17) % 86400 AS STRING) AS time,
               CAST(l_linenumber AS STRING) AS duration, 'C' || CAST(l_suppkey % 97 AS STRING) AS src_comp,
               {_port("l_partkey")} AS src_port, 'C' || CAST(l_partkey % 97 AS STRING) AS dst_comp,
               {_port("l_suppkey")} AS dst_port, CASE WHEN l_orderkey % 2 = 0 THEN '6' ELSE '17' END AS protocol,
               CAST(CAST(l_quantity AS BIGINT) AS STRING) AS packet_count,
               CAST(CAST(l_quantity AS BIGINT) * 64 + l_linenumber AS STRING) AS byte_count
        FROM {_twice("{lineitem}", "l_orderkey % 10 < 3")} l""",
    "dns": """
        SELECT CAST({seconds} AS STRING) AS time, 'C' || CAST(user_id % 97 AS STRING) AS src_comp,
               'C' || CAST((event_id * 5) % 131 AS STRING) AS resolved_comp
        FROM {events} e WHERE event_type = 'view'""",
    "redteam": f"""
        SELECT DISTINCT CAST({{seconds}} AS STRING) AS time, {_user("user_id", "event_id")} AS user,
               'C' || CAST((user_id * 7 + event_id) % 97 AS STRING) AS src_comp,
               'C' || CAST((user_id * 13 + event_id * 3 + 1) % 97 AS STRING) AS dst_comp
        FROM {{events}} e WHERE event_id % 997 = 0""",
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("events", "lineitem") if f"{{{t}}}" in RAW_SQL[name]}
    return spark.sql(RAW_SQL[name].replace("{seconds}", _SPARK_SECONDS), **tables)


def raw_sql(name: str) -> str:
    """The same rows for DuckDB."""
    return RAW_SQL[name].format(seconds=_DUCK_SECONDS, events="events", lineitem="lineitem").replace(" AS user,", ' AS "user",')


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return SOURCES[name].to_bronze(raw(spark, sf_dir, name))


def silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spec.to_silver(bronze(spark, sf_dir, name)) for name, spec in SOURCES.items()}


def raw_lines(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw rows as lines of text (column value)."""
    from pyspark.sql import functions as F

    rows = raw(spark, sf_dir, name)
    return as_read(rows.select(F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in rows.columns]).alias("value")))


def as_read(lines: DataFrame) -> DataFrame:
    """Lines (value) as if they came from a file: each is made once, however often a plan names it."""
    from pyspark.sql import functions as F

    return lines.select(F.explode(F.array("value")).alias("value"))
