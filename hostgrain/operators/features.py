"""One row of features per computer, for one window of days or many at once.

Events are first reduced per day, in one aggregate for each source: counts and
sums per (day, computer), and the distinct values per (day, computer, kind). That
table is stored, and windows are made from it by changes: what happened on a day is
added at the first anchor whose window holds it and taken off again where that ends;
a value counts once while windows of its days overlap. Sums of the changes up to an
anchor are that anchor's features. So a day makes two changes at most, however long
windows are and however many overlap, events are read once (and shuffled twice: to
drop repeated rows, and to reduce them), and distinct counts stay exact. Additive and
distinct measures meet in one aggregate in place of a chain of outer joins. Rows without a computer are left out; see unidentified().
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from hostgrain.functions.columns import is_hidden_port
from hostgrain.operators.contract import COLUMNS, FEATURES, FLAGS, KEYS, RATES
from hostgrain.sources.events import SOURCES
from hostgrain.sources.tables import stored

#: Distinct measures: feature -> (kind of value, people only).
_DISTINCT = {
    "auth_out_distinct_targets": ("auth_out_peer", False),
    "auth_in_distinct_sources": ("auth_in_peer", False),
    "auth_out_distinct_users": ("auth_out_user", False),
    "auth_in_distinct_users": ("auth_in_user", False),
    "auth_out_distinct_human_users": ("auth_out_user", True),
    "auth_in_distinct_human_users": ("auth_in_user", True),
    "proc_distinct_process_names": ("proc_name", False),
    "proc_distinct_users": ("proc_user", False),
    "proc_distinct_human_users": ("proc_user", True),
    "flows_out_distinct_targets": ("flows_out_peer", False),
    "flows_in_distinct_sources": ("flows_in_peer", False),
    "dns_distinct_resolved_hosts": ("dns_host", False),
}
#: Logs of which many events are of the same computers and values.
ALIKE = ("flows",)
#: Known outcomes, from which the failure rates are made.
_KNOWN = ("auth_out_known", "auth_in_known")
_ADDITIVE = [f for f in FEATURES if f not in _DISTINCT and f not in RATES] + list(_KNOWN)


def _one(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("long")


def _roles(name: str) -> list[tuple[Column, dict[str, Column], dict[str, tuple[Column, Column]]]]:
    """For each role that a computer has in an event: the computer, what is added, and the values by kind with whether a person."""
    c, nobody, one = F.col, F.lit(False), F.lit(1).cast("long")
    if name == "auth":
        out = []
        for role, own, other, user in (("out", "src", "dst", "src"), ("in", "dst", "src", "dst")):
            person = F.coalesce(~c(f"{user}_user_is_machine"), F.lit(False))
            added = {
                f"auth_{role}_event_count": one,
                f"auth_{role}_failed_count": _one(~c("auth_success")),
                f"auth_{role}_known": _one(c("auth_success").isNotNull()),
            }
            values = {f"auth_{role}_peer": (c(f"{other}_comp"), nobody), f"auth_{role}_user": (c(f"{user}_user_name"), person)}
            out.append((c(f"{own}_comp"), added, values))
        return out
    if name == "proc":
        person = F.coalesce(~c("user_is_machine"), F.lit(False))
        added = {"proc_start_count": _one(F.lower("event_type") == "start")}
        return [(c("computer"), added, {"proc_name": (c("process_name"), nobody), "proc_user": (c("user_name"), person)})]
    if name == "flows":
        return [
            (
                c(f"{own}_comp"),
                {
                    f"flows_{role}_count_distinct": one,
                    f"flows_{role}_bytes_sum_distinct": F.coalesce("byte_count", F.lit(0)).cast("long"),
                    f"flows_{role}_packets_sum_distinct": F.coalesce("packet_count", F.lit(0)).cast("long"),
                    f"flows_{role}_anonymized_port_count_distinct": _one(is_hidden_port(c(f"{own}_port"))),
                },
                {f"flows_{role}_peer": (c(f"{other}_comp"), nobody)},
            )
            for role, own, other in (("out", "src", "dst"), ("in", "dst", "src"))
        ]
    return [(c("src_comp"), {"dns_lookup_count": one}, {"dns_host": (c("resolved_comp"), nobody)})]


def _summed(df: DataFrame, roles: list) -> tuple[DataFrame, list]:
    """df with a row for each day and combination of computers and values, its measures summed up, and the roles in its columns."""
    keys, sums, found = [F.col("day")], [], []
    for i, (computer, added, values) in enumerate(roles):
        keys.append(computer.alias(f"computer_{i}"))
        sums += [F.sum(amount).alias(m) for m, amount in added.items()]
        own = {}
        for kind, (value, person) in values.items():
            keys += [value.alias(kind), person.alias(f"{kind}_person")]
            own[kind] = F.col(kind), F.col(f"{kind}_person")
        found.append((F.col(f"computer_{i}"), {m: F.col(m) for m in added}, own))
    return df.groupBy(*keys).agg(*sums), found


def daily(silver: dict[str, DataFrame], first_day: int | None = None, last_day: int | None = None, alike: Iterable[str] = ()) -> DataFrame:
    """(part, source, day, computer_id, kind, value, person, additive measures): all that windows are made of.

    Part `counts` has the sums of a computer and day (and those of rows without a
    computer, which only tell that a source had rows), part `values` each distinct
    value of a kind once. Every event becomes an entry of either sort for each of
    its roles, and all entries meet in one aggregate: a source is read once. Events of
    the sources in alike are first summed up by day, computers and values, so that
    entries are made of the combinations; that shuffles partial sums once more.
    """
    parts = []
    for name, df in silver.items():
        roles = _roles(name)
        measures = [m for _, added, _ in roles for m in added]
        nothing, text = F.lit(None).cast("long"), F.lit(None).cast("string")

        def entry(computer, kind, value, person, added):
            sums = [added.get(m, nothing).alias(m) for m in measures]  # noqa: B023
            return F.struct(computer.alias("computer_id"), kind.alias("kind"), value.alias("value"), person.alias("person"), *sums)

        inside = df if first_day is None else df.where(F.col("day").between(first_day, last_day))
        if name in alike:
            inside, roles = _summed(inside, roles)
        each = [entry(computer, text, text, F.lit(False), added) for computer, added, _ in roles]
        each += [
            entry(computer, F.lit(kind), value, person, {}) for computer, _, values in roles for kind, (value, person) in values.items()
        ]
        rows = inside.select("day", F.explode(F.array(*each)).alias("e")).select("day", "e.*")
        rows = rows.where("kind is null or (computer_id is not null and value is not null)")
        found = rows.groupBy("day", "computer_id", "kind", "value", "person").agg(*[F.sum(m).alias(m) for m in measures])
        part = F.when(F.col("kind").isNull(), "counts").otherwise("values")
        parts.append(found.select(part.alias("part"), F.lit(name).alias("source"), *found.columns))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def daily_schema() -> StructType:
    """The columns of daily() for all sources."""
    text = {c: StringType() for c in ("part", "source", "computer_id", "kind", "value")}
    return StructType([StructField(c, k) for c, k in (text | {"day": IntegerType(), "person": BooleanType()}).items()] + [StructField(m, LongType()) for m in _ADDITIVE])


def stored_daily(silver: dict[str, DataFrame], first_day: int, last_day: int) -> DataFrame:
    """daily() of some days, written once: counts, values and presence read it instead of the events."""
    return stored(daily(silver, first_day, last_day), "daily", ["part"])


def _counts(days: DataFrame) -> DataFrame:
    return days.where("part = 'counts' and computer_id is not null").drop("part", "source", "kind", "value", "person")


def active_computers(silver: dict[str, DataFrame], first_day: int, last_day: int) -> DataFrame:
    """The computers that acted in some days."""
    return _counts(daily(silver, first_day, last_day)).select("computer_id").distinct()


def window_event_days(anchor_day: int, window_days: int) -> list[int]:
    """The days of the window that ends at anchor_day, from day 0 on."""
    if anchor_day < 0 or window_days < 1:
        raise ValueError("the anchor must be at least 0 and the window at least 1 day")
    return list(range(max(0, anchor_day - window_days + 1), anchor_day + 1))


def window_days_table(anchors: DataFrame, window_days: int) -> DataFrame:
    """(anchor_day, event_day) for each anchor_day of anchors, without negative ones."""
    window_event_days(0, window_days)
    days = F.sequence(F.greatest(F.lit(0), F.col("anchor_day") - window_days + 1), F.col("anchor_day"))
    return anchors.where("anchor_day >= 0").select("anchor_day").distinct().select("anchor_day", F.explode(days).alias("event_day"))


def _inside(df: DataFrame, first: int, last: int, window_days: int) -> DataFrame:
    """The rows of df whose day is in the window of an anchor first..last; days before day 0 are in none."""
    return df.where(F.col("day").between(max(0, first - window_days + 1), last))


def _changes(df: DataFrame, first: int, last: int, window_days: int, enters: Column, leaves: Column) -> DataFrame:
    """Rows of df, which are _inside(), at the anchors (anchor_day) where they enter windows (sign 1) and leave them (sign -1).

    Two rows for a day at most. What entered before the first anchor counts as
    entering there; what leaves after the last one doesn't matter.
    """
    entry = F.struct(F.greatest("day", F.lit(first)).alias("anchor_day"), enters.alias("happens"), F.lit(1).alias("sign"))
    exit_ = F.struct((F.col("day") + window_days).alias("anchor_day"), leaves.alias("happens"), F.lit(-1).alias("sign"))
    each = df.withColumn("change", F.explode(F.array(entry, exit_))).where(F.col("change.happens") & (F.col("change.anchor_day") <= last))
    return each.withColumns({"anchor_day": F.col("change.anchor_day"), "sign": F.col("change.sign")}).drop("change", "day")


def _slid(changes: DataFrame, key: str, amounts: dict[str, Column], last: int) -> DataFrame:
    """(key, anchor_day, amounts): for each anchor up to the last the sum of the changes until then, where `active` is above 0.

    A key has a row for each anchor with a change before the result is spread out.
    """
    at = changes.groupBy(key, "anchor_day").agg(*[F.sum(F.col("sign") * amount).alias(name) for name, amount in amounts.items()])
    order = Window.partitionBy(key).orderBy("anchor_day")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.lead("anchor_day").over(order), F.lit(last + 1)) - 1
    sums = at.select(key, "anchor_day", until.alias("until"), *[F.coalesce(F.sum(m).over(upto), F.lit(0).cast("long")).alias(m) for m in amounts])
    return sums.where("active > 0").withColumn("anchor_day", F.explode(F.sequence("anchor_day", "until"))).drop("until", "active")


def _presence(days: DataFrame, first: int, last: int, window_days: int) -> DataFrame:
    """(anchor_day, source_present_*) from the days (source, day), each once, on which a source has rows."""
    window_event_days(first, window_days)
    anchors = days.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias("anchor_day"))
    always, one = F.lit(True), F.lit(1).cast("long")
    found = _slid(_changes(_inside(days, first, last, window_days), first, last, window_days, always, always), "source", {"active": one, "days": one}, last)
    counted = found.groupBy("anchor_day").agg(*[F.max(F.when(F.col("source") == n, F.col("days"))).alias(f"n_{n}") for n in SOURCES])
    wanted = F.least(F.lit(window_days), F.col("anchor_day") + 1)
    flags = [F.coalesce(F.col(f"n_{n}") == wanted, F.lit(False)).alias(f"source_present_{n}") for n in SOURCES]
    return anchors.join(counted, "anchor_day", "left").select("anchor_day", *flags)


def source_presence(silver: dict[str, DataFrame], first: int, last: int, window_days: int) -> DataFrame:
    """(anchor_day, source_present_*): whether a source has rows on every day of the anchor's window."""
    days = [df.select(F.lit(n).alias("source"), "day").distinct() for n, df in silver.items()]
    return _presence(reduce(DataFrame.union, days), first, last, window_days)


def window_changes(days: DataFrame, first: int, last: int, window_days: int) -> tuple[DataFrame, dict[str, Column]]:
    """(computer_id, anchor_day, sign, ...): all changes of windows between the anchors first..last, and the amounts in them.

    A value that a computer had on several days enters where no earlier day's windows
    reach and leaves where no later day's begin.
    """
    always = F.lit(True)
    counts = _changes(_inside(_counts(days), first, last, window_days), first, last, window_days, always, always)
    values = _inside(days.where("part = 'values'").select("day", "computer_id", "kind", "value", "person"), first, last, window_days)
    in_order = Window.partitionBy("computer_id", "kind", "value", "person").orderBy("day")
    beside = values.withColumns({"before": F.lag("day").over(in_order), "after": F.lead("day").over(in_order)})
    enters = F.coalesce(F.col("day") - F.col("before") >= window_days, always)
    leaves = F.coalesce(F.col("after") - F.col("day") >= window_days, always)
    values = _changes(beside, first, last, window_days, enters, leaves).drop("value", "before", "after")
    both = counts.withColumn("active", F.lit(1)).unionByName(values, allowMissingColumns=True)
    added = {m: F.col(m) for m in (*_ADDITIVE, "active") if m in both.columns}
    sources = {f.split("_")[0] for f in added}
    distinct = {
        f: _one((F.col("kind") == kind) & (F.col("person") if people else F.lit(True)))
        for f, (kind, people) in _DISTINCT.items()
        if f.split("_")[0] in sources
    }
    return both, added | distinct


def measures(days: DataFrame, first: int, last: int, window_days: int) -> DataFrame:
    """(anchor_day, computer_id, features of the sources in days) for the anchors first..last, from daily()."""
    changes, amounts = window_changes(days, first, last, window_days)
    total = _slid(changes, "computer_id", amounts, last)
    for role in ("out", "in"):
        if f"auth_{role}_known" in amounts:
            known = F.col(f"auth_{role}_known")
            rate = F.when(known > 0, F.col(f"auth_{role}_failed_count") / known)
            total = total.withColumn(f"auth_{role}_failure_rate", rate)
    return total.drop(*_KNOWN)


def _first_day(first: int, window_days: int) -> int:
    return window_event_days(first, window_days)[0]


def source_features(name: str, silver: DataFrame, anchor_day: int, window_days: int) -> DataFrame:
    """computer_id and the features of one source, for one window."""
    days = stored_daily({name: silver}, _first_day(anchor_day, window_days), anchor_day)
    found = measures(days, anchor_day, anchor_day, window_days)
    return found.select("computer_id", *[f for f in FEATURES if f.startswith(f"{name}_") and f in found.columns])


def features_of_days(days: DataFrame, first: int, last: int, window_days: int) -> DataFrame:
    """The feature table, in contract order, for the anchors first..last, from daily()."""
    present = days.where("part = 'counts'").select("source", "day").distinct()
    found = measures(days, first, last, window_days).join(F.broadcast(_presence(present, first, last, window_days)), "anchor_day")  # a row per anchor
    return found.withColumn("window_days", F.lit(window_days)).select(*KEYS, *FEATURES, *FLAGS)


def computer_features(silver: dict[str, DataFrame], anchors: Iterable[int], window_days: int) -> DataFrame:
    """The feature table, in contract order, for consecutive anchors."""
    anchors = list(anchors)
    first, last = min(anchors), max(anchors)
    return features_of_days(stored_daily(silver, _first_day(first, window_days), last), first, last, window_days)


def unidentified(silver: dict[str, DataFrame]) -> DataFrame:
    """(source, rows): rows that lack the computer of one of their roles, and so add nothing to it."""
    parts = []
    for name, df in silver.items():
        lacking = reduce(Column.__or__, [computer.isNull() for computer, _, _ in _roles(name)])
        parts.append(df.agg(F.lit(name).alias("source"), F.count_if(lacking).alias("rows")))
    return reduce(DataFrame.union, parts)


assert len(COLUMNS) == 35
