"""The stages against plain Python on the small tables."""

from collections import Counter

from comparing import SMALL
from test_pack import check_layout, check_rows
from test_parity import brute

import corpus_pipeline as pipeline
from hostgrain.llm.storage import written


def test_stages_against_plain_python(spark, documents):
    docs, seen = documents, {}
    for name, stage in pipeline.STAGES:
        seen[name] = docs
        docs = written(stage(spark, docs, SMALL), name)
        if name != "packing":
            assert docs.columns == documents.columns
    final = docs

    kept = {r["doc_id"] for r in seen["exact_dedup"].collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    toxic, clean = ({r["doc_id"] for r in labels if r["toxic"] == x} for x in (1, 0))
    # 87 labels are few to learn from: see test_learned for what a larger sample reaches
    assert len(kept & toxic) < len(toxic) and len(kept & clean) >= 0.95 * len(clean)

    newest = {}
    for r in seen["exact_dedup"].collect():
        newest[r["text"] or ""] = max(r["doc_id"], newest.get(r["text"] or "", -1))
    assert sorted(r["doc_id"] for r in seen["near_dedup"].collect()) == sorted(newest.values())

    rows = [(r["doc_id"], r["text"]) for r in seen["near_dedup"].collect()]
    heads = {head for _, head in brute(rows, 5, 80).values()}
    assert {r["doc_id"] for r in seen["source_mix"].collect()} == heads

    times = Counter(r["doc_id"] for r in seen["packing"].collect())
    assert set(times) <= heads and max(times.values()) <= 2
    words = lambda t: len((t or "").split())
    source = {r["doc_id"]: (r["source"], words(r["text"])) for r in seen["source_mix"].collect()}
    size, taken = Counter(), Counter()
    for i, (s, n) in source.items():
        size[s] += n
        taken[s] += n * times[i]
    assert abs(sum(taken.values()) / sum(size.values()) - 1.5) < 0.2

    packed = final.collect()
    check_layout(packed, 2048)
    once = {(r["doc_id"], r["piece"]): r for r in packed}
    check_rows(list(once.values()), [(r["doc_id"], r["text"]) for r in seen["packing"].dropDuplicates(["doc_id"]).collect()], 2048)
    assert Counter((r["doc_id"], r["piece"]) for r in packed) == Counter({k: times[k[0]] for k in once})


def test_run_is_all_stages(spark):
    assert pipeline.run(spark, SMALL).count() > 0 and pipeline.ORACLE_SQL is None and len(pipeline.STAGES) == 5
