"""The four event logs: their raw layout and the way to Bronze and Silver."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hostgrain.functions.columns import account_domain, account_name, as_long, day_of, is_machine, outcome


@dataclass(frozen=True)
class EventSource:
    """A log by name: its fields in order, and the columns of its Silver table."""

    name: str
    fields: tuple[str, ...]
    silver_columns: Callable[[], list]

    @property
    def raw_schema(self) -> StructType:
        return StructType([StructField(f, StringType()) for f in self.fields])

    def to_bronze(self, raw: DataFrame) -> DataFrame:
        """The raw fields by position, verbatim, with the source's name and the day of their time.

        Further columns are dropped. A time that is no number gives a null day.
        """
        named = raw.select(*[F.col(f"`{c}`").cast("string").alias(f) for c, f in zip(raw.columns, self.fields, strict=False)])
        if len(named.columns) < len(self.fields):
            raise ValueError(f"{self.name} needs {len(self.fields)} fields, got {len(named.columns)}")
        return named.withColumns({"source": F.lit(self.name), "day": day_of(as_long(F.col("time")))})

    def to_silver(self, bronze: DataFrame) -> DataFrame:
        """Typed and conformed rows, each once; rows without a day are left to quarantine()."""
        typed = bronze.where("day is not null").select(
            as_long(F.col("time")).alias("time"), F.col("day").cast("int").alias("day"), "source", *self.silver_columns()
        )
        return typed.dropDuplicates()

    def quarantine(self, bronze: DataFrame) -> DataFrame:
        """Rows whose time is no number."""
        return bronze.where("day is null")


def _auth() -> list:
    src, dst = F.col("src_user"), F.col("dst_user")
    return [
        account_name(src).alias("src_user_name"),
        account_domain(src).alias("src_domain"),
        account_name(dst).alias("dst_user_name"),
        account_domain(dst).alias("dst_domain"),
        *[F.col(c) for c in ("src_comp", "dst_comp", "auth_type", "logon_type", "auth_orientation")],
        is_machine(src).alias("src_user_is_machine"),
        is_machine(dst).alias("dst_user_is_machine"),
        outcome(F.col("success")).alias("auth_success"),
    ]


def _proc() -> list:
    user = F.col("user")
    return [
        account_name(user).alias("user_name"),
        account_domain(user).alias("domain"),
        is_machine(user).alias("user_is_machine"),
        *[F.col(c) for c in ("computer", "process_name", "event_type")],
    ]


def _flows() -> list:
    return [
        as_long(F.col("duration")).alias("duration"),
        *[F.col(c) for c in ("src_comp", "src_port", "dst_comp", "dst_port", "protocol")],
        as_long(F.col("packet_count")).alias("packet_count"),
        as_long(F.col("byte_count")).alias("byte_count"),
    ]


def _dns() -> list:
    return [F.col("src_comp"), F.col("resolved_comp")]


# The fields of each log, by position.
SOURCES = {
    s.name: s
    for s in (
        EventSource(
            "auth",
            ("time", "src_user", "dst_user", "src_comp", "dst_comp", "auth_type", "logon_type", "auth_orientation", "success"),
            _auth,
        ),
        EventSource("proc", ("time", "user", "computer", "process_name", "event_type"), _proc),
        EventSource(
            "flows",
            ("time", "duration", "src_comp", "src_port", "dst_comp", "dst_port", "protocol", "packet_count", "byte_count"),
            _flows,
        ),
        EventSource("dns", ("time", "src_comp", "resolved_comp"), _dns),
    )
}


def source(name: str) -> EventSource:
    if name not in SOURCES:
        raise ValueError(f"unknown source {name!r}: known are {', '.join(SOURCES)}")
    return SOURCES[name]
