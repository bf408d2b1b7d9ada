"""Exact search over ball trees against scores of all pairs by plain Python."""

import math
import re
from collections import Counter

import numpy as np
from comparing import SMALL, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hostgrain.llm import ball_search as bs

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return _TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


@given(st.text(st.sampled_from("aBZz09 \x00\x7f\x85\xa0é😀_-.\n")))
def test_terms(text):
    assert [t.decode() for t in bs.terms_of(text.encode())] == _terms(text)
    assert bs.terms_of(None) == []


def _brute(docs, items, top=10):
    """(item_id, rank, doc_id, score) by the contract: docs and items are (id, text)."""
    counted = [(doc_id, Counter(_terms(text))) for doc_id, text in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n_docs, total = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item_id, text in items:
        scores = []
        for (doc_id, counts), n in zip(counted, lengths, strict=True):
            score = 0
            for t in _terms(text):
                if t in counts:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + (75 * n * n_docs) // total
                    score += w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scores)[:top], 1):
            found.append((item_id, rank, None if null else doc_id, -score))
    return sorted(found, key=str)


def _found(frame):
    assert frame.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_messy_tables(spark):
    """Nulls in any column, repeated rows and ids, ties, empty and very long texts, clashing columns; one block and many."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(3000)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(i, texts[3]) for i in range(5000, 5600)]  # a large group of copies
    docs += [(1, texts[1]), (1, "other w7"), (None, texts[3]), (None, None), (6000, None), (6001, ""), (6002, "?!"), (6003, "W7 " * 50_000), (6004, "x" * 200_000)]
    items = [(0, texts[3]), (1, "w7 W7 w7"), (1, "w9 nowhere"), (2, None), (3, "nowhere"), (None, "w1 w2 w3"), (4, ""), (5, "x" * 200_000)]
    items += [(10 + i, " ".join(rng.choice(words, 30))) for i in range(20)]
    frames = [spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")]
    for clash in ("key", "n", "terms", "counts", "rank", "score", "docs", "starts"):
        frames = [f.withColumn(clash, F.lit("clash")) for f in frames]
    wanted = _brute(docs, items)
    assert _found(bs.search(*frames)) == wanted
    assert _found(bs.search(*frames, block_terms=100)) == wanted  # several blocks of items


def test_no_rows(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert _found(bs.search(docs.limit(0), items)) == _found(bs.search(docs, items.limit(0))) == []
    assert _found(bs.search(spark.createDataFrame([(1, "...")], docs.schema), items)) == []


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000))
def test_no_score_exceeds_its_bounds(seed):
    """Every node's bound holds for all of its documents, and every document is in one leaf."""
    rng = np.random.default_rng(seed)
    n_terms, n_docs = int(rng.integers(1, 300)), int(rng.integers(1, 200))
    sizes = rng.integers(1, min(n_terms, 40) + 1, n_docs)
    terms = np.concatenate([rng.choice(n_terms, k, replace=False) for k in sizes])
    gain = rng.integers(0, 1_000_000, len(terms))
    weights = rng.integers(0, 10_000, n_terms)
    scale = np.sqrt(weights.astype(float))
    shard = bs.ball_tree(np.arange(n_docs), np.concatenate(([0], np.cumsum(sizes))), terms, gain, scale)
    leaves = sorted((s, e) for s, e, left, _ in shard.nodes if not left)
    assert [s for s, _ in leaves] == [0, *[e for _, e in leaves[:-1]]] and leaves[-1][1] == n_docs
    assert sorted(shard.docs) == list(range(n_docs)) and max(e - s for s, e in leaves) <= bs.LEAF
    asked = [sorted(rng.choice(n_terms, min(n_terms, 12), replace=False)) for _ in range(5)]
    asked = [[t for t in own if weights[t] > 0] for own in asked]
    flat = np.array([t for own in asked for t in own], np.int64)
    factors = weights[flat] * rng.integers(1, 4, len(flat))
    block = bs.Items(list(range(5)), np.cumsum([0, *map(len, asked)]), flat, factors, scale)
    balls = bs.Balls.of(shard, scale)
    bounds = balls.bounds(block, range(5))
    for i in range(5):
        own = dict(zip(flat[block.starts[i] : block.starts[i + 1]], factors[block.starts[i] : block.starts[i + 1]], strict=True))
        scores = [
            sum(int(own.get(t, 0)) * int(g) for t, g in zip(shard.terms[a:b], shard.gains[a:b], strict=True))
            for a, b in zip(shard.starts[:-1], shard.starts[1:], strict=True)
        ]
        for node, (start, end, _, _) in enumerate(shard.nodes):
            assert max(scores[start:end]) <= bounds[i, node]
        best = sorted(((s, -int(d)) for s, d in zip(scores, shard.docs, strict=True) if s > 0), reverse=True)[:10]
        assert sorted(balls.search(block, i, bounds[i], (1, -bs.NO_ID), 10, None), reverse=True) == best


def test_query_equals_sql(spark, duck):
    wanted = rows_of(duck.sql(bs.ORACLES["op13_ball_search"]).df())
    assert rows_of(bs.op13(spark, SMALL).toPandas()) == wanted
