"""A Merkle manifest of a dataset, and proofs by octopus multiproof.

Rows are leaves. The leaves of a group (a language) in order form a binary tree, a
lone last node of a level being hashed alone; the groups' roots in order form the
top tree. The manifest stores every node by its coordinates (tree, level, index).

Leaves are dealt out by range of (group, order), so their places come from counts
per task, and no task holds a group. Trees are raised from blocks of 2^BITS
neighbours, a table for every BITS levels. For proofs, the leaves are cut into
partitions of 2^BITS neighbours, which may span groups. Each partition works out the
smallest set of coordinates that the paths of all its leaves need and that can't be
derived from the leaves themselves, gets these nodes in one join, derives the
interiors that paths share once, and expands each leaf's proof where it is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain, groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostgrain.llm.storage import fresh, table, written

#: Leaves in a block and in a partition: 2^BITS.
BITS = 11
#: The tree over the groups' roots; groups are called `-` (null) or `=name`.
TOP = ""


def field(value: Column) -> Column:
    """A value as the count of its UTF-8 bytes, a colon, and itself; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def digest(*nodes: str) -> str:
    """The parent of nodes, which are hexadecimal, as is the result."""
    return sha256("".join(nodes).encode()).hexdigest()


def height(n: int) -> int:
    """The level of the root over n leaves."""
    return (n - 1).bit_length()


def octopus(wanted: Iterable[int], n: int) -> list[tuple[int, int]]:
    """The coordinates (level, index), each once, that paths of the wanted leaves of n need and that these can't derive."""
    found, here, level = [], sorted(set(wanted)), 0
    while n > 1:
        own = set(here)
        found += [(level, i ^ 1) for i in here if i ^ 1 < n and i ^ 1 not in own]
        here = sorted({i >> 1 for i in here})
        n, level = (n + 1) >> 1, level + 1
    return found


def derive(nodes: dict[tuple[int, int], str], wanted: Iterable[int], n: int) -> str:
    """Adds to nodes what lies on the paths of the wanted leaves, and returns the root; nodes has them and octopus()'s."""
    here, level = sorted(set(wanted)), 0
    while n > 1:
        here = sorted({i >> 1 for i in here})
        for i in here:
            left, right = (level, 2 * i), (level, 2 * i + 1)
            nodes[level + 1, i] = digest(nodes[left], nodes[right]) if 2 * i + 1 < n else digest(nodes[left])
        n, level = (n + 1) >> 1, level + 1
    return nodes[level, 0]


def siblings(nodes: dict[tuple[int, int], str], i: int, n: int) -> list[tuple[bool, str | None]]:
    """For each level of leaf i's path whether its node stands to the right of the other, and the other, if there is one."""
    found, level = [], 0
    while n > 1:
        found.append((bool(i & 1), nodes[level, i ^ 1] if i ^ 1 < n else None))
        i, n, level = i >> 1, (n + 1) >> 1, level + 1
    return found


def folded(leaf: str, path: list[tuple[bool, str | None]]) -> str:
    for right, other in path:
        leaf = digest(leaf) if other is None else digest(other, leaf) if right else digest(leaf, other)
    return leaf


def _rows(batches) -> Iterator[tuple]:
    return chain.from_iterable(zip(*(c.to_pylist() for c in b.columns), strict=True) for b in batches)


def _batches(rows: Iterable[tuple], schema: str, size: int = 8192) -> Iterator:
    """Arrow batches of rows, with the names and types (string, long or boolean) of schema."""
    import pyarrow as pa

    types = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    fields = [(name, types[kind]) for name, kind in (f.split() for f in schema.split(", "))]
    ready: list[tuple] = []

    def batch():
        columns = zip(*ready, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])

    for row in rows:
        ready.append(row)
        if len(ready) >= size:
            yield batch()
            ready.clear()
    if ready:
        yield batch()


_NODES = "tree string, level long, index long, digest string, n long"


def _raised(batches):
    def rows():
        for (tree, base, n, block), nodes in groupby(_rows(batches), key=lambda r: (r[0], r[1], r[2], r[3])):
            level, index, here = base, block << BITS, [r[5] for r in nodes]
            while level < min(base + BITS, height(n)):
                here = [digest(*here[i : i + 2]) for i in range(0, len(here), 2)]
                level, index = level + 1, index >> 1
                for i, node in enumerate(here):
                    yield tree, level, index + i, node, n

    yield from _batches(rows(), _NODES)


def nodes_of(leaves: DataFrame) -> DataFrame:
    """(tree, level, index, digest, n) of all nodes over leaves (tree, index, digest, n); n is a tree's count of leaves."""
    level = leaves.select("tree", F.lit(0).cast("long").alias("level"), "index", "digest", "n")
    found, base = [level], 0
    most = level.agg(F.max("n")).first()[0] or 0
    while base < height(max(most, 1)):
        block = F.shiftright("index", BITS).alias("block")
        blocks = level.select("tree", "level", "n", block, "index", "digest").repartition("tree", "block")
        raised = written(blocks.sortWithinPartitions("tree", "level", "n", "block", "index").mapInArrow(_raised, _NODES), "nodes")
        found.append(raised)
        base += BITS
        level = raised.where(F.col("level") == base)
    union = found[0]
    for df in found[1:]:
        union = union.unionByName(df)
    return union


def _ordered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """rows with `at`, ascending in (tree, *order), and (tree, part, first, before, n) for each task and tree.

    Row `at` of part at >> 33 is number at - first + before of the n rows of its tree.
    """
    by = [F.col("tree").asc(), *[F.col(c).asc_nulls_first() for c in order]]
    # equal rows may stand in any order; their place in the input only deals them out to several tasks
    told_apart = rows.withColumn("copy", F.monotonically_increasing_id())
    dealt = told_apart.repartitionByRange(*by, "copy").sortWithinPartitions(*by, "copy").drop("copy")
    placed = written(dealt.withColumn("at", F.monotonically_increasing_id()), "ordered")
    counts = placed.groupBy("tree", F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before, n = F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"), F.sum("rows").over(tree).alias("n")
    return placed, written(counts.select("tree", "part", "first", before, n), "counts")


def _placed(placed: DataFrame, counts: DataFrame) -> DataFrame:
    """placed with the columns of counts and `index`, the place in the tree."""
    keyed = placed.withColumn("part", F.shiftright("at", 33))
    return keyed.join(counts, ["tree", "part"]).withColumn("index", F.col("at") - F.col("first") + F.col("before"))


@dataclass(frozen=True)
class Manifest:
    """leaves: the given columns with tree, index, n, rank, groups and at; nodes: all nodes by coordinates."""

    leaves: DataFrame
    nodes: DataFrame


def build_manifest(leaves: DataFrame, group: Column, order: list[str]) -> Manifest:
    """The manifest of leaves, which have a column leaf (hexadecimal digest).

    Leaves ascend by order (null first) in each group, groups by their bytes (null
    first). Equal leaves may repeat: each has its place. An empty table has no node.
    Names of columns must not be tree, index, n, rank, groups, at, part, first or before.
    """
    rows = leaves.withColumn("tree", F.coalesce(F.concat(F.lit("="), group), F.lit("-")))
    placed, counts = _ordered(rows, order)
    groups = counts.groupBy("tree").agg(F.max("n").alias("n"))
    ranked = _placed(*_ordered(groups.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name")), ["name"]))
    ranks = written(ranked.select(F.col("name").alias("tree"), F.col("index").alias("rank"), F.col("n").alias("groups")), "ranks")
    # a row for each task and group is joined first, so that no large group meets in one task
    full = counts.join(ranks, "tree")
    ready = written(_placed(placed, full).drop("part", "first", "before"), "leaves")
    own = nodes_of(ready.select("tree", "index", F.col("leaf").alias("digest"), "n"))
    roots = own.where(F.col("level") == F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0))
    tops = roots.join(ranks, "tree").select(F.lit(TOP).alias("tree"), F.col("rank").alias("index"), "digest", F.col("groups").alias("n"))
    return Manifest(ready, own.unionByName(nodes_of(written(tops, "roots"))))


_ASKED = "bundle long, tree string, level long, index long"


def _asked(batches):
    def rows():
        for bundle, wanted in groupby(_rows(batches), key=lambda r: r[0]):
            trees, ranks, groups = {}, set(), 0
            for _, tree, index, n, rank, groups in wanted:
                trees.setdefault((tree, n), []).append(index)
                ranks.add(rank)
            for (tree, n), own in trees.items():
                yield from ((bundle, tree, level, i) for level, i in octopus(own, n))
            yield from ((bundle, TOP, level, i) for level, i in octopus(ranks, groups))
            yield bundle, TOP, height(groups), 0

    yield from _batches(rows(), _ASKED)


_PROVEN = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _expanded(batches):
    def rows():
        for _, entries in groupby(_rows(batches), key=lambda r: r[0]):
            nodes: dict[str, dict[tuple[int, int], str]] = {TOP: {}}
            wanted, trees, root, groups = [], {}, None, 0
            for _, tree, level, index, node, n, rank, groups_, at, id_, claimed in entries:
                own = nodes.setdefault(tree, {})
                own[level, index] = node
                if at is not None:
                    wanted.append((tree, index, node, id_, claimed))
                    trees.setdefault(tree, (n, rank, []))[2].append(index)
                    groups = groups_
            root = nodes[TOP][height(groups), 0]  # as published
            subroots = {tree: derive(nodes[tree], indices, n) for tree, (n, _, indices) in trees.items()}
            nodes[TOP] |= {(0, trees[tree][1]): subroot for tree, subroot in subroots.items()}
            derive(nodes[TOP], (rank for _, rank, _ in trees.values()), groups)
            tops = {tree: siblings(nodes[TOP], rank, groups) for tree, (_, rank, _) in trees.items()}
            for tree, index, node, id_, claimed in wanted:
                path = siblings(nodes[tree], index, trees[tree][0]) + tops[tree]
                found = folded(claimed, path)
                proof = digest(*(other for _, other in path if other is not None))
                yield id_, node, subroots[tree], root, proof, found, found == root

    yield from _batches(rows(), _PROVEN)


def prove(manifest: Manifest, wanted: DataFrame) -> DataFrame:
    """Proofs of some leaves: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    wanted has rows of manifest.leaves, all or any, with their columns id, leaf and
    claimed, the digest that is folded along the path in place of leaf; verified says
    whether that gives the published root. proof_sha256 is the digest of all siblings,
    leaf to root.
    """
    rows = wanted.withColumn("bundle", F.shiftright("at", BITS))
    bare = rows.select("bundle", "tree", "index", "n", "rank", "groups").repartition("bundle").sortWithinPartitions("bundle")
    asked = bare.mapInArrow(_asked, _ASKED)
    fetched = asked.join(manifest.nodes, ["tree", "level", "index"]).select("bundle", "tree", "level", "index", F.col("digest").alias("node"))
    zero = F.lit(0).cast("long").alias("level")
    own = rows.select("bundle", "tree", zero, "index", F.col("leaf").alias("node"), "n", "rank", "groups", "at", "id", "claimed")
    both = own.unionByName(fetched, allowMissingColumns=True).repartition("bundle").sortWithinPartitions("bundle", "at")
    return both.mapInArrow(_expanded, _PROVEN)


def document_leaves(docs: DataFrame) -> DataFrame:
    """(id, tag, leaf, claimed): the leaves of documents, and as claimed those of tampered rows.

    Where 7 divides the CRC-32 of the decimal id, tampering adds 1 to n_chars; a null
    id or n_chars stays as it is. Whole texts count; other columns are ignored.
    """
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    id_, source, lang, n_chars, text = (F.col(f"`{c}`") for c in columns)
    hit = F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 7 == 0, F.lit(False))
    changed = F.when(hit, leaf_digest(id_, source, lang, F.try_add(n_chars, F.lit(1)), text)).otherwise(F.col("leaf"))
    tag = fresh(docs, "tag")
    leaf = docs.select(id_.cast("long").alias("id"), lang.alias(tag), leaf_digest(id_, source, lang, n_chars, text).alias("leaf"), *[F.col(f"`{c}`") for c in columns])
    return leaf.select("id", F.col(tag).alias("tag"), "leaf", changed.alias("claimed"))


def prove_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Documents ascend by id (null first), rows that share one by leaf; repeated rows are
    leaves of their own. No document gives no row.
    """
    manifest = build_manifest(document_leaves(docs), F.col("tag"), ["id", "leaf"])
    return prove(manifest, manifest.leaves).withColumnRenamed("id", "doc_id")


def op11(spark, sf_dir):
    return prove_documents(table(spark, sf_dir, "documents"))


def _sql_field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR END"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_sql_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


# CRC-32 by bits: the reversed polynomial is 0xEDB88320
_SQL_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda v, i: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT)"""


def _sql_levels(name: str, start: str) -> str:
    return f"""{name}(tree, level, i, h, n) AS ({start} UNION ALL
        SELECT tree, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2 FROM {name} WHERE n > 1 GROUP BY tree, level + 1, i // 2)"""


def _sql_fold(name: str, nodes: str, start: str) -> str:
    return f"""{name}(k, tree, level, i, n, h, proof) AS ({start} UNION ALL
        SELECT f.k, f.tree, f.level + 1, f.i // 2, (f.n + 1) // 2,
               sha256(CASE WHEN s.h IS NULL THEN f.h WHEN f.i % 2 = 0 THEN f.h || s.h ELSE s.h || f.h END), f.proof || coalesce(s.h, '')
        FROM {name} f LEFT JOIN {nodes} s ON s.tree = f.tree AND s.level = f.level AND s.i = f.i + 1 - 2 * (f.i % 2) WHERE f.n > 1)"""


QUERIES = {"op11_merkle_manifest": op11}
ORACLES = {
    "op11_merkle_manifest": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_sql_leaf("n_chars")} AS leaf,
                   CASE WHEN {_SQL_CRC} % 7 = 0 THEN {_sql_leaf("n_chars + 1")} ELSE {_sql_leaf("n_chars")} END AS claimed FROM documents
        ), p AS (
            SELECT *, row_number() OVER () AS k, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                   count(*) OVER (PARTITION BY tree) AS n FROM d
        ), {_sql_levels("nodes", "SELECT tree, 0, i, leaf, n FROM p")},
        subs AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
        {_sql_levels("top", "SELECT '', 0, i, subroot, n FROM subs")},
        {_sql_fold("inner_path", "nodes", "SELECT k, tree, 0, i, n, claimed, '' FROM p")},
        {_sql_fold("outer_path", "top", "SELECT f.k, '', 0, s.i, s.n, f.h, f.proof FROM inner_path f JOIN subs s ON s.tree = f.tree WHERE f.n = 1")}
        SELECT p.doc_id, p.leaf, subs.subroot, r.h AS root, sha256(o.proof) AS proof_sha256, o.h AS folded_root, o.h = r.h AS verified
        FROM p JOIN subs ON subs.tree = p.tree JOIN outer_path o ON o.k = p.k AND o.n = 1 CROSS JOIN (SELECT h FROM top WHERE n = 1) r
    """
}
