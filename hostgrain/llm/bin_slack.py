"""Best-fit packing of token sequences by minimum bin slack.

Texts are tokenised where they are read; from then on only the lengths travel.
There are at most `capacity` different lengths, so the histogram that the packing
works on has a fixed size whatever the number of documents. For each bin the
longest piece left is placed and a bitset subset-sum over the lengths left finds
the fullest feasible combination, which is removed; while its lengths last, the
same combination fills as many bins as it can. Pieces are then numbered within
their length by many tasks and look up their place in the plan.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostgrain.llm.storage import table, tidy, written

CAPACITY = 2048
#: Pieces of one length that one task numbers, about, at most.
SHARD_ROWS = 1_000_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, the rest from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def _encoder(path: str):
    """Text -> ids of the byte-level BPE file at path.

    The file's vocabulary lists its merges in order, so ids are ranks, which
    tiktoken applies several times faster than tokenizers; texts that hold a
    special token go to tokenizers.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, special = _byte_letters(), [t["content"] for t in spec["added_tokens"]]
    ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = lru_cache(maxsize=1)(lambda: __import__("tokenizers").Tokenizer.from_file(path))

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return slow().encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def cut(ids: list[int], capacity: int) -> list[tuple[int, int, int]]:
    """(start, length, CRC-32 of the ids) of each piece; only the first may be shorter than capacity if there are more."""
    data = np.asarray(ids, dtype="<u4")
    first = (len(data) - 1) % capacity + 1
    starts = [0, *range(first, len(data), capacity)]
    return [(a, b - a, zlib.crc32(data[a:b].tobytes())) for a, b in zip(starts, [*starts[1:], len(data)])]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_col="doc_id", text_col="text"):
    """doc_id, piece, start, length, ids_crc32 of every piece of every row; a null text has the end token only."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(tokenizer)
        for batch in batches:
            ids, places, rows = [], [], []
            for doc_id, text in zip(batch["doc_id"].astype(object), batch["text"]):
                for n, row in enumerate(cut([*encode(text or ""), end_id], capacity)):
                    ids.append(None if pd.isna(doc_id) else doc_id)
                    places.append(n)
                    rows.append(row)
            frame = pd.DataFrame(rows, columns=["start", "length", "ids_crc32"], dtype="int64")
            frame.insert(0, "doc_id", pd.array(ids, dtype="Int64"))
            frame.insert(1, "piece", np.array(places, dtype="int32"))
            yield frame

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(tidy(pieces), _PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How often to use which length so that their sum is the largest of at most room.

    Bit s of `reach` says that s is a sum. Copies of a length are added in groups
    of 1, 2, 4, ..; each step keeps the sums that are new, for the way back.
    """
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, group = min(counts[length], room // length), 1
        while left > 0:
            times = min(group, left)
            new = (reach << (length * times)) & mask & ~reach
            if new:
                steps.append((new, length, times))
                reach |= new
            left, group = left - times, group * 2
        if reach >> room & 1:
            break
    used: dict[int, int] = {}
    at = reach.bit_length() - 1
    for new, length, times in reversed(steps):
        if at and new >> at & 1:
            used[length] = used.get(length, 0) + times
            at -= length * times
    return used


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, length -> uses in each) until no piece is left; counts has capacity entries at most."""
    left, plan = {k: v for k, v in counts.items() if v > 0}, []
    while left:
        longest = max(left)
        others = left | {longest: left[longest] - 1}
        used = fullest({k: v for k, v in others.items() if v > 0}, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        bins = min(left[k] // n for k, n in used.items())
        plan.append((bins, used))
        for k, n in used.items():
            left[k] -= n * bins
            if not left[k]:
                del left[k]
    return plan


def _plan_table(plan: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """A row per combination and length: which ranks of the length it takes, and where they go."""
    rows, taken, sequence = [], {}, 0
    for bins, used in plan:
        offset = 0
        for length in sorted(used, reverse=True):
            first = taken.get(length, 0)
            rows.append((length, first, used[length], sequence, offset))
            taken[length] = first + bins * used[length]
            offset += length * used[length]
        sequence += bins
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "uses", "sequence", "offset"), columns))


def pack(pieces: DataFrame, capacity: int = CAPACITY, shards: int = 256, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length; lengths are 1 to capacity.

    Pieces of a length are numbered in `shards` parts or, where those would hold more
    than about shard_rows, in as many as the rows take.
    Rows that are equal in all columns are packed one by one. No rows: none.
    """
    pieces = written(pieces, "pieces")
    shards = max(shards, -(-pieces.count() // shard_rows))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)).cast("int"))
    sizes = written(pieces.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n")), "piece-lengths")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _plan_table(plan_bins(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(
        F.col("length").alias("l"), F.col("shard").alias("s"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    in_shard = F.row_number().over(Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = (
        pieces.withColumn("in_shard", in_shard)
        .join(base, (F.col("length") == F.col("l")) & (F.col("shard") == F.col("s")))
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("in_shard")).alias("rank"))
    )
    wide = np.int64(1) << np.int64(44)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = places["length"] * wide + places["first"]
        for batch in batches:
            rank = batch.pop("rank").to_numpy()
            length = batch["length"].to_numpy()
            at = np.searchsorted(keys, length * wide + rank, side="right") - 1
            nth = rank - places["first"][at]
            batch["sequence_id"] = places["sequence"][at] + nth // places["uses"][at]
            batch["offset"] = places["offset"][at] + nth % places["uses"][at] * length
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            yield batch

    return ranked.mapInPandas(tidy(place), f"{_PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, **columns) -> DataFrame:
    """Packs the tokens of every row into sequences of at most capacity tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    Null and empty texts give one piece with the end token. Repeated rows are packed
    as often as they occur, null ids too. Further columns are ignored.
    """
    if tokenizer is None:
        from public_tokenizers import path

        tokenizer = path("byte_bpe_50k.json")
    return pack(token_pieces(docs, tokenizer, capacity, **columns), capacity)


def op6(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op6_bin_slack": op6}
ORACLES: dict[str, str] = {}
