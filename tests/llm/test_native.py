"""Exact duplicates and source mix: SQL on the small tables, and odd input."""

from collections import Counter

import pytest
from comparing import SMALL, rows_of

from hostgrain.llm import exact_dedup, registry, source_mix


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_against_sql(spark, duck, name):
    names, rows = rows_of(registry.QUERIES[name](spark, SMALL).toPandas())
    wanted_names, wanted = rows_of(duck.sql(registry.ORACLES[name]).df())
    assert names == wanted_names and rows == wanted


def test_no_python_on_the_native_paths(spark):
    for name in ("op7_exact_dedup", "op10_source_mix"):
        plan = registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_copies_of_messy_rows(messy, nothing):
    rows = exact_dedup.exact_duplicates(messy).collect()
    assert len(rows) == messy.count()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[1]["keep_id"] == 2 and by_id[1]["group_size"] == 4 and not by_id[1]["kept"]
    assert sum(r["kept"] for r in rows if r["keep_id"] == 2) == 2  # the repeated row shares its verdict
    assert by_id[3]["keep_id"] == 4 and by_id[4]["kept"]  # null equals empty
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    kept = exact_dedup.keep_one_copy(messy)
    assert kept.columns == messy.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == {2: 2, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1, 10: 1}


@pytest.mark.parametrize("heavy", [1, 3])
def test_light_and_heavy_groups_agree(documents, heavy):
    few = exact_dedup.exact_duplicates(documents, heavy=heavy, tracked=8)
    assert sorted(few.collect()) == sorted(exact_dedup.exact_duplicates(documents).collect())


def test_mix_of_messy_rows(messy, nothing):
    rows = source_mix.mix_sources(messy).collect()
    assert len(rows) == messy.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert sorted(rows, key=str) == sorted(source_mix.mix_sources(messy.repartition(3)).collect(), key=str)
    assert source_mix.mix_sources(nothing).count() == 0
    mixed = source_mix.mixed_documents(messy)
    assert mixed.columns == messy.columns and mixed.count() > 0


def test_rows_that_share_an_id_are_mixed_on_their_own(spark):
    # a third of all rows has the id 1, each with a text of its own
    rows = [(1 if i % 3 == 0 else i, f"w{i} " * (1 + i % 5), ("a", "b", None)[i % 4 % 3]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    times = Counter(r["text"] for r in source_mix.mixed_documents(docs).collect())
    assert times == Counter(r["text"] for r in source_mix.mixed_documents(docs.repartition(2)).collect())
    targets = {r["source"]: (r["source_size"], r["target"]) for r in source_mix.mix_sources(docs, text_key="h").collect()}
    for source, (size, target) in targets.items():
        of = [(t, len(t.split())) for _, t, s in rows if s == source]
        assert sum(n for _, n in of) == size
        assert abs(sum(times[t] * n for t, n in of) - target) <= 5 and all(times[t] <= 2 for t, _ in of)


def _brute_fill(sizes, weights, total, epochs):
    """Clamp what is above its cap and share the excess by weight, until nothing is."""
    target, fixed = {}, set()
    while True:
        left = total - sum(epochs * sizes[s] for s in fixed)
        free = sum(weights[s] for s in sizes if s not in fixed)
        target = {s: epochs * sizes[s] if s in fixed else left * weights[s] / free for s in sizes}
        above = {s for s in sizes if s not in fixed and target[s] > epochs * sizes[s]}
        if not above:
            return target
        fixed |= above


def test_targets_against_repeated_clamping(documents):
    rows = source_mix.mix_sources(documents).join(documents.select("doc_id", "source"), "doc_id").collect()
    sizes, got, target, largest = Counter(), Counter(), {}, Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        got[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    wanted = _brute_fill(sizes, weights, 1.5 * sum(sizes.values()), 2)
    assert all(abs(target[s] - wanted[s]) < 1e-6 * wanted[s] + 1e-9 for s in sizes)
    assert all(abs(got[s] - target[s]) <= largest[s] for s in sizes)


def test_buckets_do_not_change_the_choice(documents):
    one = source_mix.mix_sources(documents, buckets=1).collect()
    assert sorted(one) == sorted(source_mix.mix_sources(documents).collect())


def test_rows_go_whole_where_the_bitmap_is_full(spark, monkeypatch):
    from pyspark.sql import functions as F

    from hostgrain.llm import storage

    docs = spark.range(300).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    dropped = spark.createDataFrame([(i,) for i in range(1, 200, 3)] + [(None,)], "gone long")
    for bits in (8, 1 << 29):
        monkeypatch.setattr(storage, "MAX_BITS", bits)
        left = [r["doc_id"] for r in storage.without(docs, dropped, {"gone": F.col("doc_id")}).collect()]
        assert sorted(left) == [i for i in range(300) if i % 50 and not (i % 3 == 1 and i < 200)]
