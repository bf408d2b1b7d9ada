"""Ranked lexical search: exact best documents by inner product, over sparse ball trees.

A document's vector holds a gain for each term, a whole number made from the term's
count and the document's length; an item's vector holds its terms' counts times
their weights. A score is their inner product. Items are taken in blocks whose
terms, and nothing else, are counted in the documents, where they lie. Documents are
cut into shards, each a ball tree: a node is a range of documents with a centroid
and the radius around it, taken apart by groups of terms, so that an item's bound

    item . centroid + sum over groups of |item in the group| * radius in the group

(Cauchy and Schwarz in each group) leaves out groups in which it has no term. Bounds
are rounded up by far more than floating point can err. A search opens the node with
the highest bound first and ends when that can't reach the tenth best score known;
leaves are scored in whole numbers. A first pass scores one leaf of each shard for
each item; the tenth best of these is where the second, complete pass begins.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hostgrain.llm.storage import table, tidy, written

#: Documents that are returned for an item.
TOP = 10
#: Terms of the items in a block, about: the largest thing that is sent to all tasks.
BLOCK_TERMS = 200_000
#: A shard ends with so many documents or terms counted in them.
SHARD_DOCS, SHARD_POSTINGS = 2_048, 262_144
#: Documents in a leaf, at most.
LEAF = 32
#: Groups of terms with a radius of their own.
GROUPS = 128
#: Bounds are raised by this share, and by one; sums of a million terms err by 1e-9 at most.
SLACK = 1e-8
#: Stands for a null doc_id, which comes last among equal scores.
NO_ID = (1 << 63) - 1

# Bytes of terms stay, with A-Z as a-z; all others part terms. Bytes from 0x80 on are letters of UTF-8.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in order; null has none."""
    return text.translate(_BYTES).split() if text else []


def weight(documents: int, having: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


def gains(counts: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term with a count adds, per unit of weight, in a document of a length."""
    m = 25 + (75 * lengths.astype(np.int64) * documents) // total
    counts = counts.astype(np.int64)
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


@dataclass(frozen=True)
class Items:
    """A block of items by number: keys, and their terms' numbers and factors (count times weight) in rows."""

    keys: list[int]
    starts: np.ndarray
    terms: np.ndarray
    factors: np.ndarray
    scale: np.ndarray  # root of each term's weight: documents and items share the weight in equal parts


@dataclass
class Shard:
    """Documents in the order of their tree's leaves; a node is (start, end, left, right), left is 0 for a leaf, node 0 the root."""

    docs: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    gains: np.ndarray
    nodes: np.ndarray


def _spans(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of the rows, one row after another, and where each row begins among them."""
    lengths = starts[rows + 1] - starts[rows]
    begins = np.concatenate(([0], np.cumsum(lengths)))
    return np.repeat(starts[rows] - begins[:-1], lengths) + np.arange(begins[-1]), begins


def ball_tree(docs: np.ndarray, starts: np.ndarray, terms: np.ndarray, gain: np.ndarray, scale: np.ndarray) -> Shard:
    """Splits documents in halves by their place between two distant ones, down to LEAF. Each has a term at least."""
    x = gain * scale[terms]
    local, at = np.unique(terms, return_inverse=True)
    order, nodes, todo = np.arange(len(docs)), [[0, len(docs), 0, 0]], [0]
    for node in todo:
        start, end = nodes[node][:2]
        if end - start <= LEAF:
            continue
        rows = order[start:end]
        places, begins = _spans(starts, rows)
        own, value = at[places], x[places]
        dot = lambda v: np.add.reduceat(value * v[own], begins[:-1])  # noqa: B023, E731
        squares = np.add.reduceat(value * value, begins[:-1])

        def dense(i):
            one = np.zeros(len(local))
            one[own[begins[i] : begins[i + 1]]] = value[begins[i] : begins[i + 1]]  # noqa: B023
            return one

        centre = np.bincount(own, weights=value, minlength=len(local)) / len(rows)
        first = dense(np.argmax(squares - 2 * dot(centre)))
        second = dense(np.argmax(squares - 2 * dot(first)))
        order[start:end] = rows[np.argsort(dot(second - first), kind="stable")]
        middle = (start + end) // 2
        nodes[node][2:] = len(nodes), len(nodes) + 1
        todo += [len(nodes), len(nodes) + 1]
        nodes += [[start, middle, 0, 0], [middle, end, 0, 0]]
    places, begins = _spans(starts, order)
    return Shard(docs[order], begins, terms[places], gain[places], np.array(nodes))


@dataclass
class Balls:
    """A shard with the centroid and the radii of each node, over its own terms."""

    shard: Shard
    local: np.ndarray
    at: np.ndarray
    centroids: np.ndarray
    radii: np.ndarray
    least: np.ndarray  # smallest document of each node

    @staticmethod
    def of(shard: Shard, scale: np.ndarray) -> Balls:
        local, at = np.unique(shard.terms, return_inverse=True)
        x, group = shard.gains * scale[shard.terms], local % GROUPS
        row = np.repeat(np.arange(len(shard.docs)), np.diff(shard.starts))
        centroids, radii = np.empty((len(shard.nodes), len(local))), np.empty((len(shard.nodes), GROUPS))
        for i, (start, end, _, _) in enumerate(shard.nodes):
            one = slice(shard.starts[start], shard.starts[end])
            centre = np.bincount(at[one], weights=x[one], minlength=len(local)) / (end - start)
            # squared distance within a group: that of a document without terms, changed by each term
            empty = np.bincount(group, weights=centre * centre, minlength=GROUPS)
            here = centre[at[one]]
            change = np.bincount((row[one] - start) * GROUPS + group[at[one]], weights=x[one] * x[one] - 2 * x[one] * here, minlength=(end - start) * GROUPS)
            size = np.bincount(group[at[one]], weights=x[one] * x[one], minlength=GROUPS)
            squares = empty + change.reshape(end - start, GROUPS).max(axis=0)
            centroids[i] = centre
            radii[i] = np.sqrt(np.maximum(squares, 0) + SLACK * (empty + size))  # also covers what cancels out
        least = np.array([shard.docs[start:end].min() for start, end, _, _ in shard.nodes])
        return Balls(shard, local, at, centroids, radii, least)

    def bounds(self, block: Items, chosen: range) -> np.ndarray:
        """For each chosen item and node a number that no document's score in the node exceeds."""
        item = np.zeros((len(chosen), len(self.local)))
        for i, number in enumerate(chosen):
            one = slice(block.starts[number], block.starts[number + 1])
            places = np.minimum(np.searchsorted(self.local, block.terms[one]), len(self.local) - 1)
            known = self.local[places] == block.terms[one]
            root = block.scale[block.terms[one]][known]
            item[i, places[known]] = np.divide(block.factors[one][known], root, out=np.zeros(len(root)), where=root > 0)
        norms = np.zeros((GROUPS, len(chosen)))
        np.add.at(norms, self.local % GROUPS, (item * item).T)
        return (item @ self.centroids.T + np.sqrt(norms).T @ self.radii.T) * (1 + SLACK) + 1

    def search(self, block: Items, number: int, bounds: np.ndarray, floor: tuple[int, int], top: int, leaves: int | None) -> list[tuple[int, int]]:
        """The best (score, -document) from floor on, `top` at most; leaves: score so many leaves only."""
        one = slice(block.starts[number], block.starts[number + 1])
        places = np.minimum(np.searchsorted(self.local, block.terms[one]), len(self.local) - 1)
        known = self.local[places] == block.terms[one]
        if not known.any():
            return []
        factor = np.zeros(len(self.local), np.int64)
        factor[places[known]] = block.factors[one][known]
        best, queue = [], [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < floor[0]:
                break
            start, end, left, right = self.shard.nodes[node]
            if (math.floor(-bound), -self.least[node]) < floor:
                continue
            if left:
                heapq.heappush(queue, (-bounds[left], left))
                heapq.heappush(queue, (-bounds[right], right))
                continue
            own = slice(self.shard.starts[start], self.shard.starts[end])
            scores = np.add.reduceat(factor[self.at[own]] * self.shard.gains[own], self.shard.starts[start:end] - own.start)
            for i in np.flatnonzero(scores >= max(1, floor[0])):
                found = int(scores[i]), -int(self.shard.docs[start + i])
                if found < floor:
                    continue
                if len(best) < top:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
                if len(best) == top:
                    floor = max(floor, best[0])
            if leaves is not None:
                leaves -= 1
                if not leaves:
                    break
        return best


_COUNTED = "doc_id long, n long, terms array<int>, counts array<int>"
_SHARDS = "docs array<long>, starts array<int>, terms array<int>, gains array<int>, nodes array<int>"
_HITS = "key long, score long, doc_id long"


def _counter(numbers: dict[bytes, int]):
    """A function of batches (doc_id, text in bytes) that counts the known terms, and all terms together as n."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lengths, found = [], []
                for text in part.column(1).to_pylist():
                    terms = terms_of(text)
                    counts = Counter(map(numbers.get, terms))
                    counts.pop(None, None)
                    lengths.append(len(terms))
                    found.append(counts)
                starts = pa.array(np.concatenate(([0], np.cumsum([len(c) for c in found]))), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(starts, pa.array([x for c in found for x in pick(c)], pa.int32()))
                    for pick in (Counter.keys, Counter.values)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lengths, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])

    return tidy(run)


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Where each list of an Arrow column begins, from 0, and all values."""
    starts = column.offsets.to_numpy()
    return starts - starts[0], column.values.to_numpy()[starts[0] : starts[-1]]


def _builder(documents: int, total: int, scale: np.ndarray):
    """A function of counted batches that makes shards of the documents with a known term, a row for each."""

    def shard(parts) -> Shard:
        docs, lengths, sizes, terms, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        starts = np.concatenate(([0], np.cumsum(sizes)))
        return ball_tree(docs, starts, terms, gains(counts, np.repeat(lengths, sizes), documents, total), scale)

    def row(s: Shard):
        import pyarrow as pa

        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
        values = (s.docs, s.starts, s.terms, s.gains, s.nodes.ravel())
        lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v.astype(k.to_pandas_dtype()), k)) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(lists, names=[f.split()[0] for f in _SHARDS.split(", ")])

    def run(batches: Iterator) -> Iterator:
        parts, docs, postings = [], 0, 0
        for batch in batches:
            starts, terms = _flat(batch.column(2))
            counts = _flat(batch.column(3))[1]
            ids = np.array([NO_ID if v is None else v for v in batch.column(0).to_pylist()], np.int64)
            lengths, sizes = batch.column(1).to_numpy(), np.diff(starts)
            begin = 0
            for end in range(1, batch.num_rows + 1):
                docs, postings = docs + 1, postings + int(sizes[end - 1])
                full = docs >= SHARD_DOCS or postings >= SHARD_POSTINGS
                if full or end == batch.num_rows:
                    own, entries = slice(begin, end), slice(starts[begin], starts[end])
                    parts.append((ids[own], lengths[own], sizes[own], terms[entries], counts[entries]))
                    begin = end
                if full:
                    yield row(shard(parts))
                    parts, docs, postings = [], 0, 0
        if parts:
            yield row(shard(parts))

    return tidy(run)


def _searcher(block: Items, floors: dict[int, tuple[int, int]], top: int, leaves: int | None):
    """A function of shards that searches each for all items of the block."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                docs, starts, terms, gain, nodes = (_flat(c)[1] for c in one.columns)
                balls = Balls.of(Shard(docs, starts, terms, gain.astype(np.int64), nodes.reshape(-1, 4)), block.scale)
                hits = []
                for begin in range(0, len(block.keys), 256):
                    chosen = range(begin, min(begin + 256, len(block.keys)))
                    bounds = balls.bounds(block, chosen)
                    for own, number in zip(bounds, chosen, strict=True):
                        key = block.keys[number]
                        found = balls.search(block, number, own, floors.get(key, (1, -NO_ID)), top, leaves)
                        hits += [(key, score, -doc) for score, doc in found]
                if hits:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*hits, strict=True)], names=["key", "score", "doc_id"])

    return tidy(run)


def _ranked(hits: DataFrame, top: int) -> DataFrame:
    """The best of each item, `top` at most, with their rank; Spark keeps `top` of each in every task before it shuffles."""
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _block(rows: list, weights: dict[bytes, int], numbers: dict[bytes, int]) -> Items:
    """The items of rows (key, terms), their terms with a weight above 0 in ascending order."""
    keys, starts, terms, factors = [], [0], [], []
    for r in rows:
        counts = {numbers[t]: c * weights[t] for t, c in Counter(map(bytes, r.terms)).items() if weights[t] > 0}
        keys.append(r.key)
        terms += sorted(counts)
        factors += [counts[t] for t in sorted(counts)]
        starts.append(len(terms))
    scale = np.sqrt(np.array([weights[t] for t in numbers], float))
    return Items(keys, np.array(starts), np.array(terms, np.int64), np.array(factors, np.int64), scale)


def _terms_of_items(batches):
    import pyarrow as pa

    for batch in batches:
        terms = [terms_of(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.binary()))], names=["key", "item_id", "terms"])


def _search_block(docs: DataFrame, items: DataFrame, top: int) -> DataFrame:
    """(key, rank, doc_id, score) of items (key, terms)."""
    rows = items.select("key", "terms").collect()  # about BLOCK_TERMS terms
    numbers = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r.terms}))}
    spark = docs.sparkSession
    nothing = spark.createDataFrame([], "key long, rank int, doc_id long, score long")
    if not numbers:
        return nothing
    counted = written(docs.mapInArrow(_counter(numbers), _COUNTED), "counted")
    documents, total = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not documents:
        return nothing
    having = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row for each of numbers at most
    weights = {t: weight(documents, having.get(i, 0)) for t, i in numbers.items()}
    block = _block(rows, weights, numbers)
    shards = written(counted.where(F.size("terms") > 0).mapInArrow(_builder(documents, total, block.scale), _SHARDS), "shards")
    first = _ranked(shards.mapInArrow(_searcher(block, {}, top, 1), _HITS), top).where(F.col("rank") == top)
    floors = {r.key: (r.score, -r.doc_id) for r in first.collect()}  # a row for each item of the block at most
    return _ranked(shards.mapInArrow(_searcher(block, floors, top, None), _HITS), top).select("key", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score: for each item the `top` documents of highest score above 0, ties by ascending id.

    All documents are read whole and count for the statistics: null and empty texts,
    and texts without a term, as documents without terms. Rows that share an id are
    documents of their own, as are items; a null doc_id comes after all others of its
    score (the largest long can't be told from it). Items without terms, or whose terms
    no document has, give no rows, as do empty tables. Other columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    keyed = items.select(F.monotonically_increasing_id().alias("key"), F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("binary").alias("text"))
    kind = keyed.schema["item_id"].dataType.simpleString()
    asked = written(keyed.mapInArrow(_terms_of_items, f"key long, item_id {kind}, terms array<binary>"), "items")
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-max(size, 1) // block_terms)
    block = F.pmod(F.xxhash64("key"), F.lit(blocks))
    found = [written(_search_block(texts, asked.where(block == b), top), "found") for b in range(blocks)]
    every = found[0]
    for df in found[1:]:
        every = every.unionByName(df)
    named = every.join(asked.select("key", "item_id"), "key")
    doc = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    return named.select("item_id", F.col("rank").cast("int").alias("rank"), doc.alias("doc_id"), "score")


def op13(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

QUERIES = {"op13_ball_search": op13}
ORACLES = {
    "op13_ball_search": f"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_SQL_TERMS} AS terms FROM documents),
        l AS (SELECT k, doc_id, coalesce(len(terms), 0)::BIGINT AS n FROM d),
        s AS (SELECT count(*) FILTER (n > 0) AS docs, sum(n)::BIGINT AS total FROM l),
        q AS (SELECT item, item_id, term, count(*) AS c FROM (
                SELECT item, item_id, unnest(terms) AS term FROM (SELECT row_number() OVER () AS item, item_id, {_SQL_TERMS} AS terms FROM benchmark)) GROUP BY ALL),
        p AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, docs),
        g AS (SELECT k, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)) AS gain FROM p JOIN l USING (k), s),
        r AS (SELECT item, item_id, k, doc_id, sum(c * w * gain)::BIGINT AS score FROM q JOIN w USING (term) JOIN g USING (term) GROUP BY ALL)
        SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM r WHERE score > 0 QUALIFY rank <= 10
    """
}
