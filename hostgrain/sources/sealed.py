"""Sealed rows: envelope encryption with AES-GCM, bound to the partition and the columns.

Each delivered partition has a data key of its own, made at random. A row's values are
one ciphertext under that key; the partition's id and the names of the columns are
authenticated along, so rows can't be moved elsewhere. The data key travels wrapped:
encrypted under a key derived from the secret, bound to the partition. A new secret
wraps the same data keys again, and no row is touched. Keys are columns of a small
table, a row per partition, that is broadcast; literal keys would be shown in plans
and logs. Within a row null differs from the empty string; no length or pattern of
single values shows, but that of the row.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCHEME = "envelope-aes-gcm-v2"
#: The columns that name a partition.
PARTITION = ("window_days", "anchor_day")
ROW = "sealed"
_KEY, _OPENED = "data_key", "opened"
_KEYS = "window_days int, anchor_day int, wrapped_key string"


def key_id(secret: str) -> str:
    """A name of the key that doesn't give it away."""
    return hashlib.sha256(secret.encode()).hexdigest()[:12]


def partition_id(window_days: Column, anchor_day: Column) -> Column:
    return F.format_string("window_days=%d/anchor_day=%02d", window_days, anchor_day)


def _bound(names: str) -> Column:
    return F.encode(F.concat_ws("/", partition_id(*map(F.col, PARTITION)), F.lit(names)), "UTF-8")


def _encrypted(value: Column, key: Column, names: str) -> Column:
    return F.aes_encrypt(value, key, F.lit("GCM"), F.lit("DEFAULT"), F.lit(b""), _bound(names))


def _with_secret(df: DataFrame, secret: str, name: str) -> DataFrame:
    key = df.sparkSession.createDataFrame([(secret,)], f"{name} string").select(F.unhex(F.sha2(name, 256)).alias(name))
    return df.crossJoin(F.broadcast(key))  # one row


def new_keys(spark: SparkSession, partitions: Iterable[tuple[int, int]], secret: str) -> DataFrame:
    """(window_days, anchor_day, data_key, wrapped_key): a random key for each partition, in clear and wrapped; held by the driver."""
    fresh = [(w, a, secrets.token_bytes(32)) for w, a in partitions]
    keys = spark.createDataFrame(fresh, f"window_days int, anchor_day int, {_KEY} binary")
    wrapped = _with_secret(keys, secret, "secret").select(*PARTITION, _KEY, F.base64(_encrypted(F.col(_KEY), F.col("secret"), "data key")).alias("wrapped_key"))
    return spark.createDataFrame(wrapped.collect(), f"window_days int, anchor_day int, {_KEY} binary, wrapped_key string")  # encrypted once: each time is different


def open_keys(wrapped: DataFrame, secret: str) -> DataFrame:
    """(window_days, anchor_day, data_key) of wrapped (window_days, anchor_day, wrapped_key); with another secret an error."""
    key = F.aes_decrypt(F.unbase64("wrapped_key"), F.col("secret"), F.lit("GCM"), F.lit("DEFAULT"), _bound("data key"))
    return _with_secret(wrapped.select(*PARTITION, "wrapped_key"), secret, "secret").select(*PARTITION, key.alias(_KEY))


def rewrapped(wrapped: DataFrame, old_secret: str, new_secret: str) -> DataFrame:
    """(window_days, anchor_day, wrapped_key): the same data keys under another secret."""
    opened = _with_secret(open_keys(wrapped, old_secret), new_secret, "secret")
    return opened.select(*PARTITION, F.base64(_encrypted(F.col(_KEY), F.col("secret"), "data key")).alias("wrapped_key"))


def _hidden(columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c not in PARTITION]


def _names(columns: Iterable[str]) -> str:
    return ",".join(columns)


def seal(df: DataFrame, keys: DataFrame) -> DataFrame:
    """(window_days, anchor_day, sealed): df with all columns but those two as one ciphertext. keys: of new_keys()."""
    hidden = _hidden(df.columns)
    row = F.to_json(F.array(*[F.col(c).cast("string") for c in hidden]))
    keyed = df.join(F.broadcast(keys.select(*PARTITION, _KEY)), list(PARTITION))  # a row per partition
    return keyed.select(*PARTITION, _encrypted(F.encode(row, "UTF-8"), F.col(_KEY), _names(hidden)).alias(ROW))


def _opened(rows: DataFrame, keys: DataFrame, columns: list[str], decrypt) -> DataFrame:
    """rows with their values as an array of strings; a partition without a key has none that fits."""
    keyed = rows.join(F.broadcast(keys.select(*PARTITION, _KEY)), list(PARTITION), "left")  # a row per partition
    key = F.coalesce(F.col(_KEY), F.unhex(F.lit("00" * 32)))
    plain = decrypt(F.col(ROW), key, F.lit("GCM"), F.lit("DEFAULT"), _bound(_names(columns)))
    return keyed.withColumn(_OPENED, F.from_json(F.decode(plain, "UTF-8"), "array<string>"))


def unseal(rows: DataFrame, keys: DataFrame, schema: StructType) -> DataFrame:
    """The rows as they were, with the types of schema; a wrong key, or a row that was changed or moved, raises."""
    hidden = _hidden(schema.names)
    opened = _opened(rows, keys, hidden, F.aes_decrypt)
    value = lambda c: F.col(c) if c in PARTITION else F.get(_OPENED, F.lit(hidden.index(c)))
    return opened.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in schema])


def tamper_report(rows: DataFrame, keys: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(partition, rows, unreadable): rows of each partition, and how many don't open with its key."""
    opened = _opened(rows, keys, _hidden(columns), F.try_aes_decrypt)
    by = partition_id(*map(F.col, PARTITION)).alias("partition")
    return opened.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(_OPENED).isNull()).alias("unreadable"))
