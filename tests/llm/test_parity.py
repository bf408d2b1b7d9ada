"""The near-duplicate join against all pairs of sets."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hostgrain.llm import parity_join as p
from hostgrain.llm.shingles import shingle_set, word_hashes


def plain_set(text, k):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(docs, k, percent):
    """id -> (set size, smallest id reachable), by comparing all pairs."""
    sets = {i: plain_set(t, k) for i, t in docs}
    head = {i: i for i in sets}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                head[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def brute_rows(docs, k, percent):
    """As brute(), where rows may share an id: (id, set size, smallest id reachable) of each row, sorted."""
    rows = list(enumerate(docs))
    own = [(n, t) for n, (_, t) in rows]
    of = dict(enumerate(i for i, _ in docs))
    heads = {i: i for i, _ in docs}

    def find(i):
        while heads[i] != i:
            i = heads[i]
        return i

    linked = brute(own, k, percent)
    for n, (_, first) in linked.items():
        x, y = find(of[n]), find(of[first])
        heads[max(x, y)] = min(x, y)
    return sorted((of[n], size, find(of[n]) if size else of[n]) for n, (size, _) in linked.items())


def result(df, k, percent):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in p.near_duplicates(df, k, percent).collect()}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAbB é\t\n\x0b\x85\xa0 ſ", max_size=60), st.integers(1, 5))
def test_sets_have_the_size_of_plain_ones(text, k):
    assert len(shingle_set(text, k)) == len(plain_set(text, k))
    assert len(word_hashes(text)) == len("".join(c if c not in " \t\n\x0b" else " " for c in text).split(" ")) - sum(
        1 for w in "".join(c if c not in " \t\n\x0b" else " " for c in text).split(" ") if not w
    )


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 300), st.integers(0, 60), st.integers(0, 60), st.sampled_from([80, 85]), st.integers(0, 10**6))
def test_similar_sets_share_a_key_and_pass_the_sketch(both, only_a, only_b, percent, seed):
    rng = np.random.default_rng(seed)
    values = np.unique(rng.integers(0, 2**63, both + only_a + only_b, dtype=np.uint64))
    a, b = np.sort(values[: both + only_a]), np.sort(np.concatenate([values[:both], values[both + only_a :]]))
    if 100 * both < percent * len(values) or not len(a) or not len(b):
        return
    keys = lambda s: {int(x) for band in p.bands_of(len(s), percent) for x in p.part_keys(s, band, percent)}
    assert keys(a) & keys(b)
    band = p.band_of(max(len(a), len(b)))
    far = p._distance(p.bit_sketch(a, band, percent), p.bit_sketch(b, band, percent))
    assert far <= p.most_different(len(a) + len(b), percent)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 300), st.integers(0, 60), st.integers(0, 60), st.sampled_from([60, 80, 85]), st.integers(0, 10**6))
def test_similar_sets_share_a_rare_shingle_in_any_order(both, only_a, only_b, percent, seed):
    rng = np.random.default_rng(seed)
    values = rng.permutation(np.unique(rng.integers(0, 2**63, both + only_a + only_b, dtype=np.uint64)))
    a, b = values[: both + only_a], np.concatenate([values[:both], values[both + only_a :]])
    if 100 * both < percent * len(values):
        return
    levels = rng.integers(0, 3, 64).astype(np.uint8)
    assert np.intersect1d(p.rarest(a, levels, percent), p.rarest(b, levels, percent)).size


def test_levels_count_all_sets(spark, monkeypatch):
    monkeypatch.setattr(p, "PLACES", 1 << 17)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, 50, dtype=np.uint64) % np.uint64(90_000)) for _ in range(40)]
    df = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sets)], "node long, shingles binary").repartition(3)
    counts = np.bincount(np.concatenate(sets).astype(np.int64) % (1 << 17), minlength=1 << 17)
    assert (p._levels(df) == (8 * np.log2(counts + 1)).astype(np.uint8)).all()


def test_counts_of_places_are_few_rows(spark):
    """A task gives one row for each piece of places, whatever it reads."""
    rng = np.random.default_rng(2)
    sets = [(i, np.sort(rng.integers(0, 2**63, 20_000, dtype=np.uint64)).tobytes()) for i in range(12)]
    df = spark.createDataFrame(sets, "node long, shingles binary").repartition(3)
    assert 0 < p._place_counts(df).count() <= 3 * -(-p.PLACES // p.PIECE)
    assert np.array_equal(p._levels(df), p._levels(df.repartition(1)))


@pytest.mark.parametrize("heavy", [1, 1000])
def test_buckets_take_keys_once(spark, monkeypatch, heavy):
    """Frequent keys or none: the same buckets, and no join that gives all other keys on."""
    monkeypatch.setattr(p, "HEAVY", heavy)
    rng = random.Random(3)
    own = [(i, sorted({rng.randrange(-40, 400) for _ in range(20)} | {7 if i % 2 else -7})) for i in range(300)]
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    found = p._buckets(spark.createDataFrame(own, "id long, keys array<long>")).collect()
    done = store.executionsList(before, 1_000)
    assert not any("LeftAnti" in done.apply(i).physicalPlanDescription() for i in range(done.size()))
    of = {}
    for i, keys in own:
        for key in keys:
            of.setdefault(key, []).append(i)
    want = sorted((key, i, min(ids), len(ids)) for key, ids in of.items() if len(ids) > 1 for i in ids)
    assert sorted((r["key"], r["id"], r["leader"], r["size"]) for r in found) == want
    assert any(r["frequent"] for r in found)


def shared_passage(n, common=300, own=100):
    """Documents that share a passage and aren't similar, and a pair of near copies for every 50 of them."""
    head = " ".join(f"c{i}" for i in range(common))
    docs = [(i, head + " " + " ".join(f"o{i}x{j}" for j in range(own))) for i in range(n)]
    return docs + [(n + i, docs[50 * i][1] + " end") for i in range(n // 50)]


def test_work_on_shared_passages_grows_with_documents(spark, monkeypatch):
    seen = []
    screen, blocks = p._screen, p._block_pairs
    monkeypatch.setattr(p, "_screen", lambda pairs, *rest: seen.append(pairs.count()) or screen(pairs, *rest))

    def counted(rows, *rest, **more):
        seen.append(sum(r["n"] ** 2 for r in rows.groupBy("key").agg(p.F.count(p.F.lit(1)).alias("n")).collect()))
        return blocks(rows, *rest, **more)

    monkeypatch.setattr(p, "_block_pairs", counted)
    work = []
    for n in (300, 1200):
        seen.clear()
        docs = shared_passage(n)
        found = result(spark.createDataFrame(docs, "doc_id long, text string"), 4, 85)
        assert {i: c for i, (_, c) in found.items() if c != i} == {n + i: 50 * i for i in range(n // 50)}
        work.append(sum(seen))
    assert work[1] <= 4**1.3 * work[0]


def near_copies(rng, n):
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(40)]
    docs = []
    for g in range(n):
        base = [rng.choice(words) for _ in range(rng.choice([3, 20, 60, 150]))]
        if rng.random() < 0.5:
            base = base[: len(base) // 3] + passage + base[len(base) // 3 :]
        for _ in range(rng.choice([1, 1, 2, 5, 30 if g == 0 else 2])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy))
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize(("seed", "k", "percent", "small", "block"), [(1, 4, 85, 24, 512), (2, 5, 80, 24, 512), (3, 4, 60, 2, 3)])
def test_components_against_all_pairs(spark, monkeypatch, seed, k, percent, small, block):
    monkeypatch.setattr(p, "SMALL_BUCKET", small)
    monkeypatch.setattr(p, "BLOCK", block)
    docs = near_copies(random.Random(seed), 40)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(df, k, percent) == brute(docs, k, percent)


@pytest.mark.parametrize(("seed", "small", "block", "heavy"), [(4, 24, 512, 1000), (5, 2, 3, 1000), (6, 4, 8, 2)])
def test_rows_that_share_an_id(spark, monkeypatch, seed, small, block, heavy):
    for name, value in (("SMALL_BUCKET", small), ("BLOCK", block), ("HEAVY", heavy)):
        monkeypatch.setattr(p, name, value)
    rng = random.Random(seed)
    docs = [(rng.choice(range(0, 40)) if rng.random() < 0.3 else i, t) for i, t in near_copies(rng, 30)]
    docs += [*docs[:5], (docs[0][0], ""), (docs[1][0], None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = sorted(tuple(r) for r in p.near_duplicates(df, 4, 85).collect())
    assert found == brute_rows(docs, 4, 85)


def test_query_over_the_whole_table(spark, documents):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert result(documents, 4, 85) == brute(docs, 4, 85)


def test_odd_rows(messy, nothing):
    rows = p.near_duplicates(messy, 4, 85).collect()
    assert len(rows) == messy.count()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None}
    assert found[1] == found[2] == found[6] == (3, 1)
    assert found[3] == (0, 3) and found[5] == (0, 5) and found[8][1] == 7 and found[10] == (1, 10)
    assert all(r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert p.near_duplicates(nothing).count() == 0
    kept = p.keep_one_of_each(messy, 4, 85)
    assert kept.columns == messy.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [1, 3, 4, 5, 7, 9, 10]
