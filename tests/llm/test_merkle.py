"""Merkle manifests against a tree built by hand, and octopus proofs of any subset."""

import zlib
from hashlib import sha256

from comparing import SMALL, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hostgrain.llm import merkle_manifest as mm


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _levels(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 70).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.integers(0, n - 1), min_size=1))))
def test_octopus_asks_for_no_more_than_is_needed(case):
    n, wanted = case
    levels = _levels([_h(str(i)) for i in range(n)])
    asked = mm.octopus(wanted, n)
    assert len(asked) == len(set(asked)) and not {(0, i) for i in wanted} & set(asked)
    known = {(0, i): levels[0][i] for i in wanted} | {(level, i): levels[level][i] for level, i in asked}
    assert mm.derive(dict(known), wanted, n) == levels[-1][0]
    for gone in asked:  # each of them is needed
        fewer = {k: v for k, v in known.items() if k != gone}
        try:
            mm.derive(fewer, wanted, n)
        except KeyError:
            continue
        raise AssertionError("a node too many")
    full = dict(known)
    mm.derive(full, wanted, n)
    for i in wanted:
        path = mm.siblings(full, i, n)
        assert mm.folded(levels[0][i], path) == levels[-1][0]
        assert (mm.folded(_h("x"), path) == levels[-1][0]) is False


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _brute(rows):
    """The contract by plain Python: rows are (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for r in rows:
        leaf = _h(*map(_field, r))
        doc_id, source, lang, n_chars, text = r
        hit = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        claimed = _h(*map(_field, (doc_id, source, lang, n_chars + 1, text))) if hit else leaf
        trees.setdefault(lang, []).append((doc_id, leaf, claimed))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        built[lang] = _levels([x[1] for x in trees[lang]])
    top = _levels([built[lang][-1][0] for lang in order])
    found = []
    for rank, lang in enumerate(order):
        for i, (doc_id, leaf, claimed) in enumerate(trees[lang]):
            siblings, node = [], claimed
            for levels, at in ((built[lang], i), (top, rank)):
                for level in levels[:-1]:
                    run = level[at & ~1 : (at & ~1) + 2]
                    siblings += [x for j, x in enumerate(run) if j != at & 1]
                    node = _h(*[node if j == at & 1 else x for j, x in enumerate(run)])
                    at >>= 1
            found.append((doc_id, leaf, built[lang][-1][0], top[-1][0], _h(*siblings), node, node == top[-1][0]))
    return found


def _check(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for clash in ("tree", "leaf", "id", "level", "index", "n", "rank", "at", "part", "claimed", "tag", "digest"):
        frame = frame.withColumn(clash, F.lit("clash"))
    found = [tuple(r) for r in mm.prove_documents(frame).collect()]
    assert sorted(map(str, found)) == sorted(map(str, _brute(rows)))


def test_messy_documents(spark):
    """Nulls in any column, repeated ids and rows, empty and very long texts, a lone leaf, clashing names."""
    rows = [(i, "s", "en", i * 3, f"text {i}") for i in range(5000)]  # more than two blocks
    rows += [(7, "s", "en", 21, "text 7")] * 3 + [(7, "other", "en", None, None), (None, None, None, None, None), (None, "s", "en", 1, "")]
    rows += [(i, None, "=", i, "x" * 100_000) for i in range(3)] + [(1, "s", "é", 1, "é"), (5, "s", "", 1, "lone")]
    _check(spark, rows)


def test_sizes(spark):
    for n in (1, 2, 3, 2048, 2049):
        _check(spark, [(i, "s", None, i, "t") for i in range(n)])
    _check(spark, [(i, "s", f"l{i:03d}", i, "t") for i in range(37)])  # many trees of one leaf


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert mm.prove_documents(empty).collect() == []


def test_some_leaves_only(spark):
    """Proofs of any rows fetch what the others' absence leaves open."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    manifest = mm.build_manifest(mm.document_leaves(docs), F.col("tag"), ["id", "leaf"])
    every = {r.id: r for r in mm.prove(manifest, manifest.leaves).collect()}
    some = mm.prove(manifest, manifest.leaves.where("id % 13 = 5")).collect()
    assert some and all(every[r.id] == r for r in some)


def test_query_equals_sql(spark, duck):
    wanted = rows_of(duck.sql(mm.ORACLES["op11_merkle_manifest"]).df())
    assert rows_of(mm.op11(spark, SMALL).toPandas()) == wanted
