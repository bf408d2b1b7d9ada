"""Checksums of table contents that don't depend on row order or layout, and their validation."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Fixed values of the digest's format.
NULL = "\x00"
SEPARATOR = "\x1f"


def row_text(columns: list[str]) -> Column:
    """All values of a row as one string, columns by name; null differs from the empty string."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL)) for c in sorted(columns)])


def row_hash(columns: list[str]) -> Column:
    """64 bits of a row's content, at a fraction of MD5's work."""
    return F.xxhash64(row_text(columns))


def _summary(columns: list[str], total: Column) -> Column:
    names = F.lit(",".join(sorted(columns)))
    return F.sha2(F.concat_ws("|", names, F.count(F.lit(1)).cast("string"), F.coalesce(total, F.lit(0)).cast("string")), 256)


def content_checksum(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, record_count, checksum): one digest of df, or of each group, in one job.

    Row hashes are added up, so equal rows count as often as they occur; shifted
    to be positive, the sum of any table fits 38 digits.
    """
    shifted = row_hash(df.columns).cast("decimal(38,0)") + F.lit(str(1 << 63)).cast("decimal(38,0)")
    total = F.sum(shifted.cast("decimal(28,0)"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("record_count"), _summary(df.columns, total).alias("checksum"))


def _md5_lane(columns: list[str]) -> str:
    """60 bits of a row's MD5 as a long, in SQL: of row_text(), whose many columns are built faster as one text."""
    values = ", ".join(f"coalesce(cast(`{c}` as string), char(0))" for c in sorted(columns))
    return f"cast(conv(substring(md5(concat_ws(char(31), {values})), 1, 15), 16, 10) as long)"


def content_checksum_md5(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """As content_checksum(), with 60 bits of MD5 as the row hash, which other engines have too."""
    total = F.expr(f"sum(cast({_md5_lane(df.columns)} as decimal(28,0)))")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("record_count"), _summary(df.columns, total).alias("checksum"))


def summary(columns: Iterable[str], rows: int, total: int) -> str:
    """The digest of content_checksum() or content_checksum_md5() for a count of rows and the sum of their hashes."""
    return hashlib.sha256(f"{','.join(sorted(columns))}|{rows}|{total}".encode()).hexdigest()


class Watch:
    """Counts and content checksums per partition, taken while rows pass by on their way to a write.

    by: the column whose values (whole numbers, known beforehand) are the partitions.
    kinds: conditions (SQL) by name; each kind's rows are summed up on their own. The sums
    are observed metrics: Spark merges them from the tasks that write, so that nothing
    is read again. Behind the last shuffle each row counts once; before it, the rows of
    a task that had to be repeated may count twice, which the caller has to allow for.
    digest: `md5` gives the checksums of content_checksum_md5(), `xxhash64` those of
    content_checksum(), summed up in halves that fit longs (2^31 rows of a partition).
    """

    #: Partitions that one Watch can keep apart, as each adds to the work for a row.
    MOST = 64
    #: A row's hash, of 60 bits, with a one in front: the sum tells rows and total of up to 10^10 rows.
    _ROW = 10**28

    def __init__(self, by: str, values: Iterable[int], columns: Iterable[str], kinds: dict[str, str] | None = None, digest: str = "md5"):
        self.by, self.values, self.columns = by, list(values), list(columns)
        self.kinds, self.digest = kinds or {"all": "true"}, digest
        if len(self.values) > self.MOST:
            raise ValueError(f"at most {self.MOST} partitions at a time")
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        """df, watched; its columns stay as they are."""
        row, place = "hostgrain_row", "hostgrain_place"
        if self.digest == "md5":
            hash_ = F.expr(f"cast(cast('{self._ROW}' as decimal(38,0)) + cast({_md5_lane(self.columns)} as decimal(20,0)) as decimal(38,0))")
            amounts = {"": f"case when {{}} then {row} end"}
        else:
            hash_ = row_hash(self.columns)
            amounts = {" rows": "if({}, 1L, 0L)", " high": f"if({{}}, shiftright({row}, 32), 0L)", " low": f"if({{}}, {row} & 4294967295L, 0L)"}
        # partitions by their place in the list: watches of as many partitions are the same code, which Spark compiles once;
        # a short list is looked up as a whole, as a number would be part of the code
        first, last = self.values[0], self.values[-1]
        neighbours = len(self.values) > 16 and self.values == list(range(first, last + 1))
        at = F.expr(f"`{self.by}` - ({first})" if neighbours else f"array_position(array({', '.join(map(str, self.values))}), cast(`{self.by}` as int)) - 1")
        sums = [
            F.expr(f"sum({amount.format(f'({condition}) and {place} = {i}')}) as `{kind} {i}{part}`")
            for kind, condition in self.kinds.items()
            for i in range(len(self.values))
            for part, amount in amounts.items()
        ]
        return df.withColumns({row: hash_, place: at}).observe(self._seen, *sums).drop(row, place)

    def found(self, kind: str = "all") -> dict[int, tuple[int, str]]:
        """(rows, checksum) of each partition with rows, once what on() returned has been written."""
        seen, parts = self._seen.get, {}
        for i, v in enumerate(self.values):
            if self.digest == "md5":
                parts[v] = divmod(int(seen.get(f"{kind} {i}") or 0), self._ROW)
            elif rows := seen.get(f"{kind} {i} rows"):  # content_checksum() adds 2^63 to each hash
                parts[v] = rows, (seen[f"{kind} {i} high"] << 32) + seen[f"{kind} {i} low"] + (rows << 63)
        return {v: (rows, summary(self.columns, rows, total)) for v, (rows, total) in parts.items() if rows}


def checksum_validation(recorded: DataFrame, computed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, status): ok, missing where nothing is recorded, mismatch where another digest is. Null keys match."""
    old = recorded.select(*[F.col(k).alias(f"r_{k}") for k in keys], F.col("checksum").alias("r_checksum"))
    condition = [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys]
    status = (
        F.when(F.col("r_checksum").isNull(), "missing").when(F.col("r_checksum") == F.col("checksum"), "ok").otherwise("mismatch")
    )
    return computed.join(old, condition, "left").select(*keys, "record_count", status.alias("status"))


def missing_partitions(present: DataFrame, sources: list[str], days: list[int]) -> DataFrame:
    """(source, day) that are wanted and not among the rows of present."""
    spark = present.sparkSession
    wanted = spark.createDataFrame([(s, d) for s in sources for d in days], "source string, day int")
    return wanted.join(present.select("source", "day").distinct(), ["source", "day"], "left_anti")
