"""Column expressions on raw event fields. None raises on malformed input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def as_long(field: Column) -> Column:
    """The field as a number; null where it isn't one."""
    return field.try_cast("long")


def day_of(seconds: Column) -> Column:
    """Day of a second count that starts at 1: second 86,400 is still day 0."""
    return F.floor((seconds - 1) / F.lit(SECONDS_PER_DAY)).cast("int")


def account_name(user: Column) -> Column:
    """The part of name@domain before the @; the whole text without one."""
    return F.get(F.split(user, "@"), F.lit(0))


def account_domain(user: Column) -> Column:
    """The part after the first @, null without one."""
    return F.get(F.split(user, "@"), F.lit(1))


def is_machine(user: Column) -> Column:
    return F.endswith(account_name(user), F.lit("$"))


def outcome(text: Column) -> Column:
    """True for success, false for fail (any case), null for all else."""
    lowered = F.lower(text)
    return F.when(lowered == "success", True).when(lowered == "fail", False)


def is_hidden_port(port: Column) -> Column:
    """Whether a port is a stand-in and not a number; null for null."""
    return ~F.rlike(port, F.lit("^[0-9]+$"))
