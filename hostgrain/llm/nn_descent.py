"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

Equal vectors are one node. A first neighbour graph comes from comparing nodes
within cells of bounded size: a cell that is too large is divided by pivots of its
own, as often as needed, so the number of pivots grows with the table. NN-descent
then improves the graph by joins, until few neighbours change: every node brings
its neighbours (and nodes that have it as a neighbour) together, and each of them
may thus find nearer ones among neighbours of neighbours. Lists are bounded, so no
group grows with the data. A query starts from the list of its own node and
repeatedly looks at the neighbours of the nearest nodes found, until it has looked
behind all of these.

While the graph is built, vectors travel as 8-bit components with a scale; cells
go by direction, neighbours by inner product, so a node's own list holds what a
query for it looks for. What the search finds is scored on the original vectors in
double precision.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hostgrain.llm.storage import table, written

#: Neighbours of a node in the graph, and how many of each sort meet at a node in a round.
NEIGHBOURS = 40
MEET = 24
#: Rounds end when a smaller share of the entries in all lists is still to be met.
SETTLED = 0.05
#: Pivots of the first cells (a bounded sample), cells for each node, and nodes compared at once, at most.
PIVOTS = 1024
CELLS = 10
CELL_SIZE = 2_000
#: Nodes of a cell that one task divides, at most, and pivots of a larger cell, which tasks divide together.
GROUP_SIZE = 16_384
FAN = 64
#: Candidates that a member of a meeting takes from it, at most: its nearest ones; it meets others elsewhere.
OFFERS = 8
#: Nodes that a query keeps, and how many it looks behind in a step.
BEAM = 240
STEP = 40


def _valid(v) -> np.ndarray | None:
    if v is None or any(x is None for x in v):
        return None
    out = np.asarray(v, dtype=np.float64)
    return out if np.isfinite(out).all() and out.any() else None


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and raw (components as doubles) of the vectors that take part.

    Left out are null ids, and null or zero vectors and such with null or non-finite components.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null and v is not null")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_valid(v) for v in batch["v"]]
            keep = np.array([f is not None for f in found], bool)
            raw = [(f + 0.0).tobytes() for f in found if f is not None]  # + 0.0: -0 becomes 0
            yield pd.DataFrame({"id": batch["id"][keep], "raw": pd.Series(raw, dtype=object, index=batch["id"][keep].index)})

    return rows.mapInPandas(check, "id long, raw binary")


def distinct_nodes(rows: DataFrame, copies: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, raw) and members (node, id), the `copies` smallest ids of each node; node is the smallest."""
    hashed = rows.select("id", "raw", F.sha2("raw", 256).alias("hash"))
    first = written(hashed.groupBy("hash").agg(F.min("id").alias("node"), F.min("raw").alias("raw")), "nodes")
    # the smallest ids first within shares of a group, so that a large group isn't one task's
    share = Window.partitionBy("hash", F.pmod(F.xxhash64("id"), F.lit(256))).orderBy("id")
    some = hashed.select("hash", "id", F.row_number().over(share).alias("r")).where(F.col("r") <= copies).select("hash", "id").distinct()
    few = some.withColumn("r", F.row_number().over(Window.partitionBy("hash").orderBy("id"))).where(F.col("r") <= copies)
    members = few.join(first.select(F.col("hash").alias("h"), "node"), F.col("hash") == F.col("h")).select("node", "id")
    return first.select("node", "raw"), written(members, "members")


def _packed(x: np.ndarray) -> bytes:
    scale = np.float32(max(np.abs(x).max(), 1e-30) / 127)
    return scale.tobytes() + np.rint(x / scale).astype(np.int8).tobytes()


def _unpacked(rows) -> np.ndarray:
    both = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    return both[:, 4:].view(np.int8).astype(np.float32) * np.ascontiguousarray(both[:, :4]).view(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)


def _doubles(rows) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest entries of each row, any order."""
    k = min(k, scores.shape[1])
    return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def _leaves(units: np.ndarray) -> list[np.ndarray]:
    """Places of the rows in parts of CELL_SIZE at most: divided by nearest pivots, as often as needed."""
    pick = np.random.default_rng(0)
    todo, out = [np.arange(len(units))], []
    while todo:
        at = todo.pop()
        if len(at) <= CELL_SIZE:
            out.append(at)
            continue
        pivots = units[pick.choice(at, min(FAN, max(2, len(at) * 4 // (CELL_SIZE * 3))), replace=False)]
        own = (units[at] @ pivots.T).argmax(1)
        parts = [at[own == j] for j in np.unique(own)]
        if max(map(len, parts)) > 0.9 * len(at):  # of one direction
            parts = np.array_split(pick.permutation(at), -(-len(at) // CELL_SIZE))
        todo += parts
    return out


def _part():
    """The share of a cell of n nodes (null: few) that a node is in, of GROUP_SIZE or so."""
    return F.pmod(F.xxhash64("node", "cell"), F.coalesce(F.ceil(F.col("n") / GROUP_SIZE), F.lit(1)))


def _divided(each: DataFrame, large: DataFrame) -> DataFrame:
    """(node, cell, was, packed): nodes of large cells (cell, n) in the cells of their nearest pivots, of which each has about FAN; was is n."""
    own = each.join(large, "cell", "left")
    rows = own.where("n is not null").withColumn("part", _part())
    pivots = rows.where(F.pmod(F.xxhash64("cell", "node"), "n") < FAN).groupBy("cell", "n").agg(F.collect_list("packed").alias("pivots"))
    pivots = written(pivots, "pivots").select(
        F.col("cell").alias("of"), F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / GROUP_SIZE) - 1)).alias("share"), "pivots"
    )

    def assign(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        near = np.zeros(len(rows), np.int64)
        if len(rows) and len(pivots):
            near = (_unit(_unpacked(rows["packed"])) @ _unit(_unpacked(sorted(pivots["pivots"].iloc[0]))).T).argmax(1)
        return pd.DataFrame({"node": rows["node"], "cell": rows["cell"], "sub": near, "was": rows["n"], "packed": rows["packed"]})

    both = rows.groupBy("cell", "part").cogroup(pivots.groupBy("of", "share"))
    divided = both.applyInPandas(assign, "node long, cell long, sub long, was long, packed binary")
    divided = divided.select("node", F.xxhash64("cell", "sub").alias("cell"), "was", "packed")
    return own.where("n is null").select("node", "cell", F.lit(0).cast("long").alias("was"), "packed").unionByName(divided)


def first_graph(nodes: DataFrame, count: int, neighbours: int) -> DataFrame:
    """(node, v, s): candidates of each node out of the cells of its nearest pivots."""
    wanted = max(1, min(PIVOTS, count * CELLS // (CELL_SIZE * 3 // 4)))
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(wanted).select("packed").collect()  # PIVOTS rows at most
    pivots = _unit(_unpacked([r["packed"] for r in sample]))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = _best(_unit(_unpacked(batch["packed"])) @ pivots.T, CELLS)
            yield pd.DataFrame({"node": batch["node"], "cells": list(near.astype(np.int32)), "packed": batch["packed"]})

    cells = nodes.mapInPandas(assign, "node long, cells array<int>, packed binary")
    cells = written(cells, "cells")
    each = cells.select("node", F.explode(F.col("cells").cast("array<long>")).alias("cell"), F.lit(2 * count).cast("long").alias("was"), "packed")
    while True:
        sizes = each.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("was").alias("was")).where(F.col("n") > GROUP_SIZE)
        sizes = written(sizes, "sizes")
        large = sizes.where("n < 0.9 * was")
        if large.isEmpty():
            break
        each = written(_divided(each.drop("was"), large.select("cell", "n")), "cells")
    # what no pivots divide is of one direction: only that is cut at random
    each = each.join(sizes.select("cell", "n"), "cell", "left").withColumn("part", _part())

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        x, ids = _unpacked(group["packed"]), group["node"].to_numpy()
        order = np.argsort(ids)
        x, ids = x[order], ids[order]
        found = {"node": [], "vs": [], "ss": []}
        for at in _leaves(_unit(x)):
            if len(at) < 2:
                continue
            s = x[at] @ x[at].T
            np.fill_diagonal(s, -np.inf)
            near = _best(s, min(neighbours, len(at) - 1))
            found["node"].extend(ids[at])
            found["vs"].extend(ids[at][near])
            found["ss"].extend(np.take_along_axis(s, near, 1))
        return pd.DataFrame(found, dtype=None if found["node"] else object)

    found = each.groupBy("cell", "part").applyInPandas(compare, "node long, vs array<long>, ss array<float>")
    return found.select("node", F.explode(F.arrays_zip("vs", "ss")).alias("x")).select("node", F.col("x.vs").alias("v"), F.col("x.ss").alias("s"))


def _lists(candidates: DataFrame, neighbours: int) -> DataFrame:
    """(node, near): the nearest of the candidates (node, v, s, fresh) by descending s; an edge seen before isn't fresh."""
    edges = candidates.groupBy("node", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("node").orderBy(F.desc("s"), "v")
    top = edges.withColumn("r", F.row_number().over(order)).where(F.col("r") <= neighbours)
    entry = F.struct("s", (-F.col("v")).alias("w"), "v", "fresh")
    return top.groupBy("node").agg(F.sort_array(F.collect_list(entry), asc=False).alias("near"))


def _meetings(graph: DataFrame, meet: int, seed: int) -> DataFrame:
    """(center, member, fresh): the nodes that meet at each node, at most 4 * meet."""
    pick = lambda fresh: F.slice(F.filter("near", lambda e: e["fresh"] == F.lit(fresh)), 1, meet)
    ahead = graph.select("node", F.explode(F.concat(pick(True), pick(False))).alias("e")).select(
        F.col("node").alias("center"), F.col("e.v").alias("member"), F.col("e.fresh").alias("fresh")
    )
    back = ahead.select(F.col("member").alias("center"), F.col("center").alias("member"), "fresh")
    mix = F.xxhash64("member", "center", F.lit(seed))
    # a node that many others have as a neighbour: some within each of 16 shares first
    share = Window.partitionBy("center", "fresh", F.pmod(F.xxhash64("member"), F.lit(16))).orderBy(mix)
    some = back.withColumn("r", F.row_number().over(share)).where(F.col("r") <= meet).drop("r")
    few = some.withColumn("r", F.row_number().over(Window.partitionBy("center", "fresh").orderBy(mix))).where(F.col("r") <= meet)
    return ahead.union(few.drop("r")).groupBy("center", "member").agg(F.max("fresh").alias("fresh"))


def _introduce(batches: Iterator) -> Iterator:
    """Offers to the members of each meeting: nearer nodes than their farthest neighbour, one of the two being fresh."""
    import pyarrow as pa

    for batch in batches:
        members = batch.column(batch.schema.get_field_index("members"))
        bounds = members.offsets.to_numpy()
        flat = members.flatten()
        ids, fresh = flat.field("member").to_numpy(zero_copy_only=False), flat.field("fresh").to_numpy(zero_copy_only=False)
        least = flat.field("least").to_numpy(zero_copy_only=False)
        vectors = _unpacked(flat.field("packed").to_pylist()) if len(ids) else np.zeros((0, 1), np.float32)
        bounds = bounds - bounds[0]
        nodes, others, scores = [], [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            new = fresh[a:b].astype(bool)
            if b - a < 2 or not new.any():
                continue
            s = vectors[a:b] @ vectors[a:b].T
            wanted = (new[:, None] | new[None, :]) & (s > least[a:b, None])
            np.fill_diagonal(wanted, False)
            s = np.where(wanted, s, -np.inf)
            near = _best(s, OFFERS)
            best = np.take_along_axis(s, near, 1)
            row, column = np.nonzero(best > -np.inf)
            nodes.append(ids[a:b][row])
            others.append(ids[a:b][near[row, column]])
            scores.append(best[row, column])
        cat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
        arrays = [pa.array(cat(nodes, np.int64)), pa.array(cat(others, np.int64)), pa.array(cat(scores, np.float32))]
        yield pa.RecordBatch.from_arrays(arrays, names=["node", "v", "s"])


def packed_nodes(nodes: DataFrame) -> DataFrame:
    """(node, packed): the vectors of nodes (node, raw) in 8-bit components."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "packed": [_packed(np.frombuffer(raw, np.float64)) for raw in batch["raw"]]})

    return written(nodes.mapInPandas(pack, "node long, packed binary"), "packed")


def neighbour_graph(packed: DataFrame, neighbours: int = NEIGHBOURS, meet: int = MEET, settled: float = SETTLED) -> DataFrame:
    """(node, near): near holds structs with v (a near node), by descending similarity; packed has node and packed."""
    count = packed.count()
    graph = written(_lists(first_graph(packed, count, neighbours // 2).withColumn("fresh", F.lit(True)), neighbours), "graph")
    for n in itertools.count():
        unmet = graph.agg(F.sum(F.size(F.filter("near", lambda e: e["fresh"]))) / F.sum(F.size("near"))).first()[0]
        if (unmet or 0) <= settled:
            break
        least = F.when(F.size("near") < neighbours, F.lit(float("-inf"))).otherwise(F.element_at("near", -1)["s"]).cast("float")
        info = packed.join(graph.select(F.col("node").alias("of"), least.alias("least")), F.col("node") == F.col("of"), "left").select(
            F.col("node").alias("who"), "packed", F.coalesce("least", F.lit(float("-inf")).cast("float")).alias("least")
        )
        met = _meetings(graph, meet, n).join(info, F.col("member") == F.col("who"))
        groups = met.groupBy("center").agg(F.collect_list(F.struct("member", "fresh", "least", "packed")).alias("members"))
        offers = groups.select("members").mapInArrow(_introduce, "node long, v long, s float").withColumn("fresh", F.lit(True))
        used = F.transform(F.slice(F.filter("near", lambda e: e["fresh"]), 1, meet), lambda e: e["v"])
        known = graph.select("node", F.explode("near").alias("e"), used.alias("used")).select(
            "node", F.col("e.v").alias("v"), F.col("e.s").alias("s"), (F.col("e.fresh") & ~F.array_contains("used", F.col("e.v"))).alias("fresh")
        )
        graph = written(_lists(known.union(offers), neighbours), "graph")
    return graph


def _score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        s = (_doubles(batch["q_raw"]) * _doubles(batch["v_raw"])).sum(1) if len(batch) else []
        yield pd.DataFrame({"q": batch["q"], "v": batch["v"], "s": s})


def exact_scores(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(q, v, s): the inner products of the pairs (q, v) of nodes, in double precision."""
    raw = lambda a, b: nodes.select(F.col("node").alias(a), F.col("raw").alias(b))
    joined = pairs.join(raw("vn", "v_raw"), F.col("v") == F.col("vn")).join(raw("qn", "q_raw"), F.col("q") == F.col("qn"))
    return joined.select("q", "v", "q_raw", "v_raw").mapInPandas(_score, "q long, v long, s double")


def _look_behind(batches: Iterator) -> Iterator:
    """For each row (q, mine, least, vs, theirs): the nodes vs that are nearer to q than `least`."""
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            q, mine, least, vs, theirs = batch.slice(at, 1000).columns
            rows = np.repeat(np.arange(len(q)), np.diff(vs.offsets.to_numpy()))
            own, near = _unpacked(mine.to_pylist()), _unpacked(theirs.flatten().to_pylist())
            s = np.einsum("ij,ij->i", own[rows], near)
            keep = s > least.to_numpy()[rows]
            arrays = [pa.array(q.to_numpy()[rows][keep]), pa.array(vs.flatten().to_numpy()[keep]), pa.array(s[keep].astype(np.float32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["q", "v", "s"])


def search_graph(graph: DataFrame, packed: DataFrame) -> DataFrame:
    """(of, vs, theirs): each node's neighbours and their packed vectors."""
    edges = graph.select("node", F.explode("near.v").alias("v"))
    joined = edges.join(packed.select(F.col("node").alias("vn"), "packed"), F.col("v") == F.col("vn"))
    lists = joined.groupBy(F.col("node").alias("of")).agg(F.collect_list(F.struct("v", "packed")).alias("near"))
    return lists.select("of", F.col("near.v").alias("vs"), F.col("near.packed").alias("theirs"))


def greedy_search(queries: DataFrame, graph: DataFrame, packed: DataFrame, beam: int = BEAM, step: int = STEP) -> DataFrame:
    """(q, v, s): the nearest nodes found from each node q of queries, `beam` at most, itself included; s by packed vectors.

    Each step looks behind the `step` nearest nodes not looked behind yet, as long
    as there are such among those kept. What is behind a node is scored where the
    node's list is, and only what is nearer than the farthest node kept travels back.
    """
    behind = written(search_graph(graph, packed), "search-graph")
    mine = written(packed.join(queries, F.col("node") == F.col("q"), "left_semi").select(F.col("node").alias("qn"), F.col("packed").alias("mine")), "asking")
    order, whole = Window.partitionBy("q").orderBy(F.desc("s"), "v"), Window.partitionBy("q")

    def keep(rows: DataFrame) -> DataFrame:
        best = rows.groupBy("q", "v").agg(F.max("s").alias("s"), F.max("done").alias("done"))
        kept = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= beam)
        full = F.max("place").over(whole) == beam
        turn = F.sum(F.when(F.col("done"), 0).otherwise(1)).over(order)
        return kept.withColumns(
            {"now": ~F.col("done") & (turn <= step), "least": F.when(full, F.min("s").over(whole)).otherwise(F.lit(float("-inf"))).cast("float")}
        )

    lists = queries.join(graph, F.col("q") == F.col("node")).select("q", F.explode("near").alias("e"))
    start = lists.select("q", F.col("e.v").alias("v"), F.col("e.s").alias("s"), F.lit(False).alias("done"))
    own = queries.select("q", F.col("q").alias("v"), F.lit(float("inf")).cast("float").alias("s"), F.lit(True).alias("done"))
    found = written(keep(start.union(own)), "beam")
    while True:
        ahead = found.where("now")
        if ahead.isEmpty():
            return found.select("q", "v", "s")
        joined = ahead.join(mine, F.col("q") == F.col("qn")).join(behind, F.col("v") == F.col("of"))
        new = joined.select("q", "mine", "least", "vs", "theirs").mapInArrow(_look_behind, "q long, v long, s float").withColumn("done", F.lit(False))
        looked = found.select("q", "v", "s", (F.col("done") | F.col("now")).alias("done"))
        found = written(keep(looked.union(new)), "beam")


def _near_nodes(nodes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(q, v, s): the nearest nodes found of each q, among those of its dimension, itself included.

    A graph for each dimension; dimensions of CELL_SIZE nodes at most are compared
    as a whole, all of them in one job.
    """
    of = (F.octet_length("raw") / 8).cast("int").alias("d")
    sizes = nodes.groupBy(of).count().orderBy(F.desc("count"), "d").collect()  # a row for each dimension
    large = [r["d"] for i, r in enumerate(sizes) if not i or r["count"] > CELL_SIZE]
    parts = []
    for d in large:
        own = nodes.where(F.octet_length("raw") == 8 * d)
        packed = packed_nodes(own)
        ask = queries.join(packed.select("node"), F.col("q") == F.col("node"), "left_semi")
        found = greedy_search(ask, neighbour_graph(packed), packed, max(BEAM, 4 * k))
        order = Window.partitionBy("q").orderBy(F.desc("s"), "v")
        pairs = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 3 * (k + 1)).select("q", "v")
        parts.append(exact_scores(written(pairs, "pairs"), own))
    if len(large) < len(sizes):
        rest = nodes.select("node", "raw", of).where(~F.col("d").isin(large)).join(queries, F.col("node") == F.col("q"), "left")

        def compare(group: pd.DataFrame) -> pd.DataFrame:
            x, ids, asks = _doubles(group["raw"]), group["node"].to_numpy(), group["q"].notna().to_numpy()
            s = x[asks] @ x.T
            return pd.DataFrame({"q": np.repeat(ids[asks], len(ids)), "v": np.tile(ids, asks.sum()), "s": s.ravel()})

        parts.append(rest.groupBy("d").applyInPandas(compare, "q long, v long, s double"))
    return functools.reduce(DataFrame.unionByName, parts)


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found of each row for which is_query holds.

    Nearness is the inner product; ties go to the smaller id; a row isn't its own
    neighbour, equal vectors of other rows are. Rows that repeat id and vector count
    once; one id with two vectors is two rows of that id. Rows without a usable vector
    (see usable()) neither ask nor answer, and vectors only meet those of their own
    dimension. Fewer than k candidates: all of them. An empty table gives no rows.
    Other columns are ignored, whatever their names.
    """
    rows = written(usable(vectors, id_col, vector_col), "usable")
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    nodes, members = distinct_nodes(rows, k + 1)
    asked = rows.where(is_query(F.col("id"))).select("id", F.sha2("raw", 256).alias("hash")).distinct()
    of_node = nodes.select(F.sha2("raw", 256).alias("h"), "node")
    asked = written(asked.join(of_node, F.col("hash") == F.col("h")).select("id", F.col("node").alias("q")), "asked")
    queries = written(asked.select("q").distinct(), "queries")
    found = written(_near_nodes(nodes, queries, k), "found")
    # the same answer for all rows of a node: one more than k, as each leaves itself out
    per_node = Window.partitionBy("q").orderBy(F.desc("s"), "vec_id")
    answers = (
        found.join(members.select("node", F.col("id").alias("vec_id")), F.col("v") == F.col("node"))
        .select("q", "vec_id", "s")
        .withColumn("r", F.row_number().over(per_node))
        .where(F.col("r") <= k + 1)
        .groupBy(F.col("q").alias("of"))
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("s")).alias("far"), "vec_id", "s"))).alias("near"))
    )
    own = asked.join(written(answers, "answers"), F.col("q") == F.col("of"))
    near = F.slice(F.filter("near", lambda e: e["vec_id"] != F.col("id")), 1, k)
    return own.select(F.col("id").alias("query_id"), F.posexplode(near).alias("pos", "e")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.s").alias("score")
    )


def op5(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), lambda id_: id_ % 20 == 0)


QUERIES = {"op5_nn_descent": op5}
ORACLES: dict[str, str] = {}
