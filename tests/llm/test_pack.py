"""Packing: ids, layout, and fullness against exhaustive search."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from hostgrain.llm import bin_slack as b


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_layout(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        ends = [0, *itertools.accumulate(n for _, n in parts)]
        assert [o for o, _ in parts] == ends[:-1] and ends[-1] <= capacity
    return len(sequences)


def check_rows(rows, texts, capacity):
    """Every text's pieces hold its ids in order; only a first piece of several is shorter."""
    encode = tokenizer()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == {i for i, _ in texts}
    for i, text in texts:
        ids = [*encode.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(pieces[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == [0, *itertools.accumulate(r["length"] for r in own)][:-1]
        assert sum(r["length"] for r in own) == len(ids) and all(r["length"] == capacity for r in own[1:])
        assert len(own) == -(-len(ids) // capacity)
        for r in own:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]


def test_query_over_the_whole_table(spark, documents):
    from comparing import SMALL

    rows = b.op6(spark, SMALL).collect()
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    check_rows(rows, texts, 2048)
    used = check_layout(rows, 2048)
    assert used <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_encoder_is_the_tokenizer():
    import public_tokenizers

    slow, fast = tokenizer(), b._encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(5)
    texts = ["", " ", "\n\n  x", "don't  é漢字🙂", "a<|endoftext|>b", "x" * 5000, "1234567 \t　​", "naïve ſ́"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 900), 32, 10])) for _ in range(80)) for _ in range(200)]
    for t in texts:
        assert fast(t) == slow.encode(t, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=9), st.integers(0, 25))
def test_fullest_against_all_subsets(lengths, room):
    counts = {x: lengths.count(x) for x in set(lengths)}
    used = b.fullest(counts, room)
    assert all(0 < n <= counts[x] for x, n in used.items())
    best = max(s for r in range(len(lengths) + 1) for c in itertools.combinations(lengths, r) if (s := sum(c)) <= room)
    assert sum(x * n for x, n in used.items()) == best


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 500), max_size=20))
def test_plan_uses_every_piece_once(counts):
    plan = b.plan_bins(counts, 40)
    used = defaultdict(int)
    for bins, combination in plan:
        assert sum(x * n for x, n in combination.items()) <= 40
        for x, n in combination.items():
            used[x] += bins * n
    assert used == counts


def test_odd_rows(spark, messy, nothing):
    rows = b.pack_documents(messy, capacity=64).collect()
    check_layout(rows, 64)
    assert sum(r["doc_id"] is None for r in rows) == 2  # "one two .." and null
    assert [r["length"] for r in rows if r["doc_id"] in (3, 4)] == [1, 1]
    assert sum(r["doc_id"] == 2 for r in rows) == 2
    assert b.pack_documents(nothing).count() == 0


def test_as_many_shards_as_the_rows_take(spark):
    rng = random.Random(9)
    rows = [(i, 0, 0, rng.choice([64, 64, 64, 40, 24, 5]), i) for i in range(600)]
    pieces = spark.createDataFrame(rows, b._PIECES)
    packed = b.pack(pieces, 64, shards=2, shard_rows=7).collect()
    assert sorted((r["doc_id"], r["length"]) for r in packed) == [(i, n) for i, _, _, n, _ in rows]
    check_layout(packed, 64)
