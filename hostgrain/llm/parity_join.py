"""Near-duplicate join on word shingles by parity sketches.

Every shingle hash is XORed into one part of its document's sketch. A shingle
that two documents share cancels out, so the parts (or, in the bit sketch, the
bits) that differ are at most as many as the shingles that only one of them has.
Documents similar enough have at most D such shingles, so of D + 1 parts one at
least is equal: equal parts are joined, per band of set sizes. Pairs then pass
the Hamming distance of their bit sketches, and what is left is verified on the
sets themselves.

Groups: in each bucket of equal parts, members are first held against one leader
only. Once the links found are merged, buckets within one component are done; in
the others, members of different components are compared. A large bucket that is
still open mostly holds documents that share a passage. Its members are dealt
once more, by their rarest shingles: two similar sets have one of so few rarest
shingles in common, while those of documents that only share a passage are their
own (`rarest`). What is large even then is compared in blocks: first the nearest
pairs of each component, then, of what is still apart, all that the sketches
allow. Thus no pair of a group is listed unless it may join two components, and
no link between components is missed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hostgrain.llm.components import components
from hostgrain.llm.shingles import mix64, shingle_set
from hostgrain.llm.storage import fresh, marked, table, tidy, without, written

GROWTH = 1.5
#: Bits of the sketch for each shingle that may differ.
BITS = 16
#: Parts of a sketch, as a multiple of the shingles that may differ: the more, the more light parts are left out.
SLACK = 1.0
#: Buckets up to this size list their pairs of different components; larger ones compare blocks.
SMALL_BUCKET = 24
#: Rounds in which each component of a large bucket only tries its nearest pair; the round after them tries all that are left.
NEAREST_ROUNDS = 2
BLOCK = 512
#: Places of the table of counts by which shingles are called rare (a byte each). The order decides about speed, never about results.
PLACES = 1 << 22
#: Places of which one task adds up the counts: those of all tasks meet there, 6 bytes a place and task at most.
PIECE = 1 << 14
#: Digests or parts that are settled map-side, at most, and counters to find them with.
HEAVY = 1_000
TRACKED = 16_384


def most_different(total: int, percent: int) -> int:
    """The most shingles that only one set has, for two sets of `total` shingles together that are similar enough."""
    return total * (100 - percent) // (100 + percent)


def band_of(n: int) -> int:
    band = int(math.log(n) / math.log(GROWTH))
    while GROWTH ** (band + 1) <= n:
        band += 1
    while GROWTH**band > n:
        band -= 1
    return band


def bands_of(n: int, percent: int) -> list[int]:
    """The bands in which a set of n shingles meets all sets it may be similar to: of its own size and of larger ones."""
    return list(range(band_of(n), band_of(max(n, n * 100 // percent)) + 1))


def _band_top(band: int) -> int:
    return math.ceil(GROWTH ** (band + 1)) - 1


def part_keys(hashes: np.ndarray, band: int, percent: int) -> np.ndarray:
    """Keys of the parts of the sketch in this band, as many as the set needs.

    Two similar sets differ in at most `bound` parts, so `parts - bound` parts hold
    the same shingles in both. Parts with few shingles tell little: a set leaves
    out those with at most `least`, as long as they are fewer than parts - bound.
    Some part with more than the larger `least` of two similar sets is then the same
    in both, and both give its key.
    """
    n, top = len(hashes), _band_top(band)
    parts = int(most_different(2 * top, percent) * SLACK) + 2
    bound = most_different(n + min(top, n * 100 // percent), percent)
    place = ((hashes >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    sketch = np.zeros(parts, np.uint64)
    np.bitwise_xor.at(sketch, place, hashes)
    filled = np.bincount(place, minlength=parts)
    below = np.cumsum(np.bincount(filled))  # parts with at most so many shingles
    least = int(np.searchsorted(below, parts - bound)) - 1
    salt = mix64(np.arange(parts, dtype=np.uint64) + (np.uint64(band + 1) << np.uint64(40)))
    keys = mix64(mix64(sketch + np.uint64(1)) + salt)
    return keys[filled > least]


def bit_sketch(hashes: np.ndarray, band: int, percent: int) -> bytes:
    """Parity bits; a Hamming distance above most_different() rules a pair out."""
    bits = 64
    while bits < BITS * most_different(2 * _band_top(band), percent):
        bits *= 2
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _digest(hashes: bytes) -> bytes:
    return hashlib.blake2b(hashes, digest_size=16).digest()


def _distance(a: bytes, b: bytes) -> int:
    return (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


_PRINT = "id long, n long, digest binary, keys array<long>, sketches array<struct<band: int, bits: binary>>"


def fingerprints(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per row of (id, text): set size, digest of the set, keys of all bands, and a bit sketch per band."""

    def prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                rows = []
                part = batch.iloc[at : at + 1000]
                for text in part["text"]:
                    hashes = shingle_set(text, k)
                    bands = bands_of(len(hashes), percent) if len(hashes) else []
                    keys = [part_keys(hashes, b, percent) for b in bands] + [np.empty(0, np.uint64)]
                    sketches = [{"band": b, "bits": bit_sketch(hashes, b, percent)} for b in bands]
                    rows.append((len(hashes), _digest(hashes.tobytes()), np.concatenate(keys).view(np.int64), sketches))
                out = pd.DataFrame(rows, columns=["n", "digest", "keys", "sketches"])
                out.insert(0, "id", part["id"].astype("Int64").to_numpy())
                yield out.astype({"id": "Int64"})

    return docs.mapInPandas(tidy(prints), _PRINT)


def _heavy(rows: DataFrame, column: str) -> DataFrame:
    """Up to HEAVY values of the column that may be frequent, found by a frequent-items sketch."""
    top = rows.agg(F.expr(f"approx_top_k({column}, {HEAVY}, {TRACKED})").alias("top"))
    return top.select(F.explode("top.item").alias(column))


def _buckets(nodes: DataFrame) -> DataFrame:
    """(key, id, leader, size, frequent) of the nodes that share a key with others; leader is the smallest id.

    Keys that may be frequent are settled map-side and marked as such.
    """
    keys = nodes.select(F.explode("keys").alias("key"), "id")
    top = [r["key"] for r in _heavy(keys, "key").collect()]  # HEAVY numbers at most
    columns, same = ["key", "id", "leader", "size"], Window.partitionBy("key")
    may_be = F.expr(f"key in ({', '.join(map(str, top))})") if top else F.lit(False)
    both = keys.where(~may_be).select(
        "key", "id", F.min("id").over(same).alias("leader"), F.count(F.lit(1)).over(same).alias("size"), F.lit(False).alias("frequent")
    )
    if top:
        some = keys.where(may_be)
        hot = written(some.groupBy("key").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("size")), "hot-keys")
        both = both.union(some.join(F.broadcast(hot), "key").select(*columns, F.lit(True)))  # HEAVY rows at most
    return written(both.where("size > 1"), "buckets")


def _screen(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b): those that sizes and bit sketches don't rule out, with the distance of their sketches."""
    side = lambda x: sketches.select(*[F.col(c).alias(f"{x}_{c}") for c in sketches.columns])

    def screen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep, far = [], []
            for na, nb, sa, sb in zip(batch["a_n"], batch["b_n"], batch["a_sketches"], batch["b_sketches"]):
                band, distance = band_of(max(na, nb)), None
                mine = next((s["bits"] for s in sa if s["band"] == band), None)
                other = next((s["bits"] for s in sb if s["band"] == band), None)
                if mine is not None and other is not None and 100 * min(na, nb) >= percent * max(na, nb):
                    distance = _distance(mine, other)
                    if distance > most_different(int(na + nb), percent):
                        distance = None
                keep.append(distance is not None)
                far.append(distance or 0)
            out = batch[["a", "b"]].assign(distance=np.array(far, np.int64))
            yield out[np.array(keep, bool)]

    joined = pairs.join(side("a"), F.col("a") == F.col("a_id")).join(side("b"), F.col("b") == F.col("b_id"))
    return joined.select("a", "b", "a_n", "b_n", "a_sketches", "b_sketches").mapInPandas(tidy(screen), "a long, b long, distance long")


def _aliases(prints: DataFrame) -> DataFrame | None:
    """(of, of_digest, alias): a node of its own for each further set of an id that stands for several; None if there are none."""
    shared = prints.groupBy("id").agg(F.min("digest").alias("first"), F.max("digest").alias("last")).where("first <> last")
    shared = written(shared.select(F.col("id").alias("of"), "first"), "shared-ids")
    if shared.isEmpty():
        return None
    further = prints.join(shared, F.col("id") == F.col("of")).where("digest <> first").select("of", F.col("digest").alias("of_digest")).distinct()
    top = prints.agg(F.max("id")).first()[0]
    if top >= 1 << 62:
        raise ValueError("ids that several texts share must be below 2 ** 62")
    return written(further.withColumn("alias", F.monotonically_increasing_id() + top + 1), "aliases")


def _as_nodes(rows: DataFrame, aliases: DataFrame | None) -> DataFrame:
    """rows (id, digest, ..) with the column node: the id, or the alias of this set of the id."""
    if aliases is None:
        return rows.withColumn("node", F.col("id"))
    joined = rows.join(aliases, (F.col("id") == F.col("of")) & (F.col("digest") == F.col("of_digest")), "left")
    return joined.withColumn("node", F.coalesce("alias", "id")).drop("of", "of_digest", "alias")


def _sets(wanted: DataFrame, docs: DataFrame, k: int, aliases: DataFrame | None) -> DataFrame:
    """(node, shingles) of the nodes w and of a few others, stored; docs has id and text. Repeated rows repeat."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [shingle_set(t, k).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "digest": [_digest(r) for r in raw], "shingles": raw})

    ids = wanted
    if aliases is not None:
        ids = wanted.join(aliases, F.col("w") == F.col("alias"), "left").select(F.coalesce("of", "w").alias("w")).distinct()
    texts = marked(docs, F.col("id"), ids, F.col("w"), "hit").where("hit").select("id", "text")
    return written(_as_nodes(texts.mapInPandas(tidy(sets), "id long, digest binary, shingles binary"), aliases).select("node", "shingles"), "sets")


def rarest(hashes: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a set, as many as are needed to meet every set that is similar enough.

    Such a set shares at least percent / 100 of the n shingles, so at most
    n - ceil(n * percent / 100) are missing in it. Let all shingles stand in one
    order. Take the first one in that order that both sets have: before it come
    only shingles that the other set lacks, on either side. So it is among the
    first n - ceil(n * percent / 100) + 1 of both, whatever the order is.
    """
    n = len(hashes)
    order = np.lexsort((hashes, levels[hashes % np.uint64(len(levels))]))
    return hashes[order[: n - -(-n * percent // 100) + 1]]


def _place_counts(sets: DataFrame) -> DataFrame:
    """(piece, counts): from each task, for each piece of PIECE places, those that its sets have (two bytes) and how often (four bytes).

    A task gives a row for each piece at most, however many sets and shingles it reads.
    """

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(PLACES, np.uint32)
        for batch in batches:
            for raw in batch["shingles"]:
                np.add.at(total, (np.frombuffer(raw, np.uint64) % np.uint64(PLACES)).astype(np.int64), 1)
        for at in range(0, PLACES, PIECE):
            part = total[at : at + PIECE]
            filled = np.flatnonzero(part)
            if len(filled):
                yield pd.DataFrame({"piece": [at // PIECE], "counts": [filled.astype(np.uint16).tobytes() + part[filled].tobytes()]})

    return sets.select("shingles").mapInPandas(tidy(counts), "piece long, counts binary")


def _levels(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each place occur in all sets, as eight times the logarithm of the count.

    Tasks add up their own counts, and pieces are added up side by side; what reaches the driver are PLACES bytes.
    """

    def piece(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(PIECE, np.int64)
        for raw in group["counts"]:
            n = len(raw) // 6
            total[np.frombuffer(raw, np.uint16, n)] += np.frombuffer(raw, np.uint32, n, 2 * n)
        return pd.DataFrame({"piece": group["piece"].iloc[:1], "levels": [np.minimum(8 * np.log2(total + 1), 255).astype(np.uint8).tobytes()]})

    levels = np.zeros(-(-PLACES // PIECE) * PIECE, np.uint8)
    for row in _place_counts(sets).groupBy("piece").applyInPandas(piece, "piece long, levels binary").toLocalIterator():  # PLACES / PIECE rows
        levels[row["piece"] * PIECE : (row["piece"] + 1) * PIECE] = np.frombuffer(row["levels"], np.uint8)
    return levels[:PLACES]


def _rare_buckets(large: DataFrame, docs: DataFrame, k: int, percent: int, aliases: DataFrame | None) -> DataFrame:
    """As _buckets(), of the ids in the large buckets by their rarest shingles."""
    ids = written(large.select(F.col("id").alias("w")).distinct(), "in-large")
    sets = _sets(ids, docs, k, aliases)
    levels = _levels(sets)

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                some = batch.iloc[at : at + 1000]
                rare = [rarest(np.frombuffer(r, np.uint64), levels, percent).view(np.int64) for r in some["shingles"]]
                yield pd.DataFrame({"id": some["node"].to_numpy(), "keys": rare})

    own = sets.join(ids, F.col("node") == F.col("w"), "left_semi").mapInPandas(tidy(keys), "id long, keys array<long>")
    return _buckets(written(own.dropDuplicates(["id"]), "rarest"))


def _verify(pairs: DataFrame, docs: DataFrame, k: int, percent: int, aliases: DataFrame | None) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets are similar enough; docs has id and text."""

    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    wanted = written(pairs.select(F.col("a").alias("w")).union(pairs.select(F.col("b").alias("w"))).distinct(), "wanted")
    found = _sets(wanted, docs, k, aliases)
    x = found.select(F.col("node").alias("xi"), F.col("shingles").alias("x"))
    y = found.select(F.col("node").alias("yi"), F.col("shingles").alias("y"))
    joined = pairs.join(y, F.col("b") == F.col("yi")).join(x, F.col("a") == F.col("xi"))
    return joined.select("a", "b", "x", "y").mapInPandas(tidy(similar), "a long, b long")


def _block_pairs(rows: DataFrame, sketches: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs of different components in large buckets that their bit sketches don't rule out.

    best: of each component in a group only the pair whose sketches are nearest.

    rows: key, id, component, size. Members go to blocks; each pair of blocks is
    compared by one group. Blocks of the bucket's largest component, which holds
    most of a hot group, are only compared with the other members.
    """
    per = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = written(
        per.groupBy(F.col("key").alias("k")).agg(
            F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n_all")
        ),
        "main",
    )
    joined = rows.join(main, F.col("key") == F.col("k"))
    is_main = F.col("component") == F.col("main")
    count = lambda n: F.greatest(F.ceil(n / F.lit(BLOCK)), F.lit(1)).cast("int")
    others = count(F.col("n_all") - F.col("n_main"))
    mains = count(F.col("n_main"))
    block = F.pmod(F.xxhash64("id"), F.when(is_main, mains).otherwise(others)).cast("int")
    with_block = joined.select("key", "id", "component", is_main.alias("is_main"), block.alias("block"), mains.alias("mains"), others.alias("others"))
    # groups: (i, j) of the other blocks with i <= j, and (-1 - m, j) for each main block m with each other block j
    of_other = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j"))),
        F.transform(F.sequence(F.lit(1), F.col("mains")), lambda m: F.struct((-m).alias("i"), F.col("block").alias("j"))),
    )
    of_main = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda j: F.struct((-1 - F.col("block")).alias("i"), j.alias("j")))
    grouped = (
        with_block.withColumn("group", F.explode(F.when(F.col("is_main"), of_main).otherwise(of_other)))
        .join(sketches.select(F.col("id").alias("sid"), "n", "sketches"), F.col("id") == F.col("sid"))
        .select("key", "group.i", "group.j", "id", "component", "n", "sketches", "block", "is_main")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("id")
        nearest: dict[int, tuple] = {}
        left = group["is_main"] if group["i"].iloc[0] < 0 else group["block"] == group["i"].iloc[0]
        right = ~group["is_main"] & (group["block"] == group["j"].iloc[0])
        out = []
        for band in sorted({s["band"] for row in group["sketches"] for s in row}):
            bits = [next((s["bits"] for s in row if s["band"] == band), None) for row in group["sketches"]]
            there = np.array([b is not None for b in bits])
            a, b = np.flatnonzero(left.to_numpy() & there), np.flatnonzero(right.to_numpy() & there)
            if not len(a) or not len(b):
                continue
            ids, sizes, parts = group["id"].to_numpy(), group["n"].to_numpy(), group["component"].to_numpy()
            packed = {i: np.frombuffer(bits[i], np.uint64) for i in {*a, *b}}
            mine = np.stack([packed[i] for i in b])
            for i in a:
                total = sizes[i] + sizes[b]
                far = np.bitwise_count(mine ^ packed[i]).sum(axis=1, dtype=np.int64)
                fits = 100 * np.minimum(sizes[i], sizes[b]) >= percent * np.maximum(sizes[i], sizes[b])
                ok = (far <= total * (100 - percent) // (100 + percent)) & fits & (parts[b] != parts[i])
                pairs = [(min(ids[i], o), max(ids[i], o)) for o in ids[b[ok]]]
                if not best:
                    out += pairs
                    continue
                for pair, share, other in zip(pairs, far[ok] / total[ok], parts[b[ok]]):
                    for component in (parts[i], other):
                        if component not in nearest or (share, pair) < nearest[component]:
                            nearest[component] = (share, pair)
        out += [pair for _, pair in nearest.values()]
        return pd.DataFrame(sorted(set(out)), columns=["a", "b"], dtype="int64")

    # few bytes, much work: as many partitions as a shuffle has, not merged by size
    spread = grouped.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "i", "j")
    return spread.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def _unsettled(buckets: DataFrame, merged: DataFrame) -> DataFrame:
    """(key, id, size, frequent, component) of the buckets with members of more than one component."""
    named = buckets.join(merged, F.col("id") == F.col("node"), "left").select(
        "key", "id", "size", "frequent", F.coalesce("component", "id").alias("component")
    )
    same = Window.partitionBy("key")
    rest = named.where(~F.col("frequent")).withColumns({"low": F.min("component").over(same), "high": F.max("component").over(same)})
    hot = named.where("frequent")
    ends = hot.groupBy(F.col("key").alias("k")).agg(F.min("component").alias("low"), F.max("component").alias("high"))
    hot = hot.join(F.broadcast(ends), F.col("key") == F.col("k"))  # HEAVY rows at most
    columns = ["key", "id", "size", "frequent", "component"]
    return rest.where("low < high").select(columns).union(hot.where("low < high").select(columns))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Documents link when 100 * intersection >= percent * union of their sets of
    k-word shingles (A-Z as a-z). component_id is the smallest id reachable by
    links, itself included. Texts without words and nulls have 0 shingles and link
    with nothing; a row without id has component_id null. Rows that share an id are
    one document with the links of each (ids that differing texts share must be below
    2 ** 62). Repeated rows get equal results, an empty table gives no rows. Other
    columns are ignored, whatever their names.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    prints = written(fingerprints(texts, k, percent), "prints")
    whole = prints.where("id is not null and n > 0")
    aliases = _aliases(whole)
    whole = _as_nodes(whole, aliases).withColumnRenamed("id", "of_id").withColumnRenamed("node", "id")
    # large groups of equal sets are settled map-side: one row of each stays
    named = whole.select("id", F.hex("digest").alias("hash"))
    hot = written(
        named.join(F.broadcast(_heavy(named, "hash")), "hash", "left_semi")
        .groupBy("hash")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1"),
        "hot-sets",
    )
    marked_sets = whole.withColumn("hash", F.hex("digest")).join(F.broadcast(hot), "hash", "left")  # HEAVY rows at most
    columns = ["id", "n", "keys", "sketches"]
    single = marked_sets.where("first_id is null").select("hash", *columns)
    leaders = marked_sets.where("id = first_id").groupBy("hash").agg(*[F.first(c).alias(c) for c in columns])
    nodes = single.unionByName(leaders.select("hash", *columns))

    rep = single.groupBy("hash").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    copies = single.select("hash", F.col("id").alias("b")).join(rep, "hash").where("a <> b").select("a", "b")
    sketches = nodes.select("id", "n", "sketches")
    buckets = _buckets(nodes)

    if aliases is not None:  # the sets of an id belong together
        own = marked_sets.select("of_id", F.coalesce("first_id", "id").alias("b")).join(aliases.select("of").distinct(), F.col("of_id") == F.col("of"), "left_semi")
        heads = own.groupBy(F.col("of_id").alias("head_of")).agg(F.min("b").alias("a"))
        copies = copies.union(own.join(heads, F.col("of_id") == F.col("head_of")).where("a <> b").select("a", "b").distinct())
    stars = buckets.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    best = _screen(stars, sketches, percent).groupBy("b").agg(F.min_by("a", F.struct("distance", "a")).alias("a"))
    links = written(_verify(written(best.select("a", "b"), "best"), texts, k, percent, aliases).union(copies), "links")
    merged = components(links)

    open_ = written(_unsettled(buckets, merged), "open")
    one, large = open_.where(F.col("size") <= SMALL_BUCKET), open_.where(F.col("size") > SMALL_BUCKET)
    if not large.isEmpty():
        large = written(_unsettled(_rare_buckets(large, texts, k, percent, aliases), merged), "open-rare")
        one = one.union(large.where(F.col("size") <= SMALL_BUCKET))
    open_ = large
    two = one.select("key", F.col("id").alias("other"), F.col("component").alias("other_component"))
    listed = (
        one.join(two, "key")
        .where((F.col("id") < F.col("other")) & (F.col("component") != F.col("other_component")))
        .select(F.col("id").alias("a"), F.col("other").alias("b"))
        .distinct()
    )
    candidates = _screen(listed, sketches, percent).select("a", "b")
    final = merged
    for turn in range(NEAREST_ROUNDS + 1):
        large = open_.where(F.col("size") > SMALL_BUCKET)
        if turn and large.isEmpty():
            break
        blocks = _block_pairs(large, sketches, percent, best=turn < NEAREST_ROUNDS)
        candidates = written((candidates.union(blocks) if not turn else blocks).distinct(), "candidates")
        more = written(_verify(candidates, texts, k, percent, aliases), "more-links")
        if not more.isEmpty():
            links = links.union(more)
            final = components(links)
        if turn < NEAREST_ROUNDS:
            open_ = written(_unsettled(large.drop("component"), final), "open")

    hot_part = hot.join(final, F.col("first_id") == F.col("node"), "left").select(
        F.col("hash"), F.coalesce("component", "first_id").alias("hot_component")
    )
    own = _as_nodes(prints.select("id", "n", "digest"), aliases).withColumnRenamed("node", "own").withColumn("hash", F.hex("digest"))
    own = own.join(F.broadcast(hot_part), "hash", "left")
    return own.join(final, F.col("own") == F.col("node"), "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when((F.col("n") == 0) | F.col("id").isNull(), F.col("id")).otherwise(F.coalesce("hot_component", "component", "id")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are the smallest id of their component, with all columns; rows without words or without id stay."""
    found, key = near_duplicates(docs, k, percent, id_col, text_col), fresh(docs, "dropped_id")
    dropped = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(key)).distinct()
    return without(docs, written(dropped, "dropped"), {key: F.col(id_col)})


def op4(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=85)


QUERIES = {"op4_parity_join": op4}
ORACLES: dict[str, str] = {}
