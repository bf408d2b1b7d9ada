"""Language identification of words and texts by a linear-chain conditional random field.

Each word of a text gets a label; its features are affixes, character n-grams and
a lexicon, all hashed into one table of weights, and neighbouring labels are tied
by learned transitions. Forward-backward gives the labels' probabilities word by
word over the whole text, so text that switches languages is labelled piecewise;
the text's language is the one with the largest mean probability. A text is one
chain, computed in blocks: the product of a block's steps carries the state from
block to block. Training maximises the likelihood of a bounded sample by
mini-batch gradient steps; some of its chains are spliced from texts of two
languages, from which the transitions learn how languages switch.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostgrain.llm.storage import table, tidy

#: Texts to train on for each language, at most: those with the smallest digests of their id.
TEXTS_PER_LANGUAGE = 250
#: Words of each of them that train, at most (evenly spread over the text's blocks).
WORDS_PER_TEXT = 640
#: Words that are computed side by side, and of a chain in training.
BLOCK = 64
#: One in so many chains of the training is spliced from two languages.
SPLICED = 2
TABLE = 1 << 16
LEXICON = 20_000
GRAMS = 4
#: Passes over the sample, and steps at least (of 256 chains each): a small sample takes more passes.
EPOCHS = 4
STEPS = 200
CACHED_WORDS = 200_000
UNKNOWN = "und"


def bare(word: str) -> str:
    """The word's letters in lower case."""
    w = word.lower()
    return w if w.isalpha() else "".join(filter(str.isalpha, w))


def feature_slots(words: list[str], lexicon: dict[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Places in the weight table and the word that each belongs to, for words made bare().

    Features are the grams of 1 to GRAMS characters of `<word>`, those with a
    bracket being affixes, and for a word of the lexicon itself and its language.
    """
    text = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(text))  # characters from here to the word's end
    slots, owners = [], []
    gram = np.zeros(len(text), np.uint64)
    for n in range(1, GRAMS + 1):
        gram[: len(text) - n + 1] = gram[: len(text) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + text[n - 1 :] + np.uint64(n)
        whole = left >= n
        hashed = (gram[whole] ^ (gram[whole] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        slots.append((hashed >> np.uint64(48)).astype(np.int64) % TABLE)
        owners.append(owner[whole])
    known = [(i, w) for i, w in enumerate(words) if w in lexicon]
    names = [x for _, w in known for x in (f"={w}", f"lexicon {lexicon[w]}")]
    slots.append(np.array([zlib.crc32(x.encode("utf-8", "surrogatepass")) % TABLE for x in names], np.int64))
    owners.append(np.repeat(np.array([i for i, _ in known], np.int64), 2))
    return np.concatenate(slots), np.concatenate(owners)


def block_products(scores: np.ndarray, there: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """(blocks, labels, labels): the product of all steps of each block from its first word on, up to a factor."""
    emit = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(transitions - transitions.max())
    product = emit[:, 0, :, None] * np.eye(scores.shape[2], dtype=emit.dtype)
    for t in range(1, scores.shape[1]):
        ahead = (product @ move) * emit[:, t, None, :]
        product = np.where(there[:, t, None, None], ahead / ahead.max(axis=(1, 2), keepdims=True), product)
    return product


def carried(products: np.ndarray, blocks: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What enters each block and what comes behind it, for texts with so many blocks each, one after another."""
    labels = products.shape[1]
    move = np.exp(transitions - transitions.max())
    enter, leave = np.full((len(products), labels), 1.0 / labels, products.dtype), np.ones((len(products), labels), products.dtype)
    ends = np.cumsum(blocks)
    order = np.argsort(-blocks, kind="stable")
    first, last, longest = (ends - blocks)[order], ends[order] - 1, blocks[order]
    for k in range(1, int(blocks.max(initial=0))):
        n = int(np.searchsorted(-longest, -k, side="left"))  # texts with more than k blocks
        at, back = first[:n] + k, last[:n] - k
        state = np.einsum("bi,bij->bj", enter[at - 1], products[at - 1]) @ move
        enter[at] = state / state.sum(1, keepdims=True)
        behind = np.einsum("bij,bj->bi", products[back + 1], leave[back + 1]) @ move.T
        leave[back] = behind / behind.sum(1, keepdims=True)
    return enter, leave


def posteriors(
    scores: np.ndarray, there: np.ndarray, transitions: np.ndarray, enter: np.ndarray | None = None, leave: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities (blocks, words, labels) and expected transition counts, by forward-backward.

    scores: emission scores; there: which words exist (padding comes last); enter and
    leave as from carried(), where blocks are parts of longer chains.
    """
    blocks, words, labels = scores.shape
    emit = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(transitions - transitions.max())
    forward = np.empty_like(emit)
    state = (np.full((blocks, labels), 1.0 / labels, emit.dtype) if enter is None else enter) * emit[:, 0]
    forward[:, 0] = state / state.sum(1, keepdims=True)
    for t in range(1, words):
        state = (forward[:, t - 1] @ move) * emit[:, t]
        forward[:, t] = state / state.sum(1, keepdims=True)
    backward = np.ones((blocks, labels), emit.dtype) if leave is None else leave
    gamma = np.empty_like(emit)
    pairs = np.zeros((labels, labels))
    for t in range(words - 1, -1, -1):
        p = forward[:, t] * backward
        gamma[:, t] = p / p.sum(1, keepdims=True)
        if t:
            ahead = emit[:, t] * backward
            joint = forward[:, t - 1].T @ (ahead * (there[:, t] / ((forward[:, t - 1] @ move) * ahead).sum(1))[:, None])
            pairs += joint * move
            step = ahead @ move.T
            backward = np.where(there[:, t, None], step / step.sum(1, keepdims=True), backward)
    return gamma, pairs


@dataclass
class Crf:
    """Weights (TABLE, labels) and transitions for the labels, and the lexicon."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: dict[str, str]
    _place: dict[str, int] = field(default_factory=dict, repr=False)
    _rows: list[np.ndarray] = field(default_factory=list, repr=False)

    def emissions(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the words, and whether each has a letter; words seen before are looked up."""
        if len(self._place) > CACHED_WORDS:
            self._place.clear()
            self._rows.clear()
        place = self._place
        new = list(set(words).difference(place))
        if new:
            place.update(zip(new, range(len(place), len(place) + len(new))))
            letters = [bare(w) for w in new]
            slots, owner = feature_slots(letters, self.lexicon)
            rows = np.empty((len(new), len(self.labels) + 1), np.float32)
            for k in range(len(self.labels)):
                rows[:, k] = np.bincount(owner, self.weights[slots, k], len(new))
            rows[:, -1] = [bool(w) for w in letters]
            rows[rows[:, -1] == 0] = 0
            self._rows.append(rows)
        if len(self._rows) > 1:
            self._rows[:] = [np.concatenate(self._rows)]
        ids = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        found = self._rows[0][ids] if len(words) else np.zeros((0, len(self.labels) + 1), np.float32)
        return found[:, :-1], found[:, -1] > 0

    def label_words(self, texts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each list of words: their label probabilities, and whether they have a letter."""
        words = [w for t in texts for w in t]
        scores, letters = self.emissions(words)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        blocks = -(-lengths // BLOCK)
        first_word = np.concatenate(([0], np.cumsum(lengths)))
        first_block = np.concatenate(([0], np.cumsum(blocks)))
        owner = np.repeat(np.arange(len(texts)), lengths)
        within = np.arange(len(words)) - first_word[owner]
        row, column = first_block[owner] + within // BLOCK, within % BLOCK
        out = np.empty((len(words), len(self.labels)), np.float32)
        starts = range(0, int(first_block[-1]), 4096)

        def padded(low: int) -> tuple:
            a, b = np.searchsorted(row, [low, low + 4096])
            size = (int(row[b - 1]) - low + 1, BLOCK)
            values, there = np.zeros((*size, len(self.labels)), np.float32), np.zeros(size, bool)
            values[row[a:b] - low, column[a:b]] = scores[a:b]
            there[row[a:b] - low, column[a:b]] = True
            return a, b, values, there

        # a chain of one block needs no product
        products = np.zeros((int(first_block[-1]), len(self.labels), len(self.labels)), np.float32)
        linked = np.repeat(blocks > 1, blocks)
        for low in starts:
            _, _, values, there = padded(low)
            some = linked[low : low + len(values)]
            products[low : low + len(values)][some] = block_products(values[some], there[some], self.transitions)
        enter, leave = carried(products, blocks, self.transitions)
        for low in starts:
            a, b, values, there = padded(low)
            part = slice(low, low + len(values))
            out[a:b] = posteriors(values, there, self.transitions, enter[part], leave[part])[0][row[a:b] - low, column[a:b]]
        return [(out[a:b], letters[a:b]) for a, b in zip(first_word[:-1], first_word[1:])]

    def languages(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language and score of each text."""
        if not self.labels:
            return [(UNKNOWN, 0.0)] * len(texts)
        out = []
        for p, letters in self.label_words([(t or "").split() for t in texts]):
            if not letters.any():
                out.append((UNKNOWN, 0.0))
                continue
            mean = p[letters].mean(axis=0, dtype=np.float64)
            best = int(mean.argmax())
            out.append((self.labels[best], float(min(1.0, max(0.0, mean[best])))))
        return out

    def __getstate__(self):
        return self.__dict__ | {"_place": {}, "_rows": []}


def fit(texts: list[str], languages: list[str], epochs: int = EPOCHS, seed: int = 7) -> Crf:
    """A field trained on texts whose words all bear their text's language (AdaGrad on the log-likelihood).

    Chains are pieces of BLOCK words; one in SPLICED goes on, from some word, as a piece of another language does.
    """
    labels = sorted(set(languages))
    blocks: list[tuple[list[str], int]] = []
    counts: dict[str, Counter] = {lab: Counter() for lab in labels}
    for text, language in zip(texts, languages):
        words = text.split()
        pieces = [words[i : i + BLOCK] for i in range(0, len(words), BLOCK)]
        step = max(1, -(-len(pieces) * BLOCK // WORDS_PER_TEXT))
        for piece in pieces[::step]:
            blocks.append((piece, labels.index(language)))
            counts[language].update(set(map(bare, piece)) - {""})
    total = sum(counts.values(), Counter())
    common = [w for w, n in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:LEXICON] if n >= 5]
    lexicon = {w: max(labels, key=lambda lab: (counts[lab][w], lab)) for w in common}
    model = Crf(labels, np.zeros((TABLE, len(labels)), np.float32), np.zeros((len(labels), len(labels)), np.float32), lexicon)
    if len(labels) < 2 or not blocks:
        return model
    vocabulary = sorted({w for words, _ in blocks for w in words})
    place = {w: i for i, w in enumerate(vocabulary)}
    flat, owners = feature_slots([bare(w) for w in vocabulary], lexicon)
    flat = flat[np.argsort(owners, kind="stable")]
    starts = np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=len(vocabulary)))))
    ids = np.full((len(blocks), BLOCK), -1)
    for i, (words, _) in enumerate(blocks):
        ids[i, : len(words)] = [place[w] for w in words]
    rng = np.random.default_rng(seed)
    gold = np.repeat(np.array([y for _, y in blocks])[:, None], BLOCK, axis=1)
    for i in rng.permutation(len(blocks))[:: SPLICED]:
        j = int(rng.integers(len(blocks)))
        cut = int(rng.integers(1, BLOCK))
        if gold[i, 0] != gold[j, -1] and ids[i, cut - 1] >= 0 and ids[j, cut] >= 0:
            ids[i, cut:], gold[i, cut:] = ids[j, cut:], gold[j, cut:]
    # transitions begin as the chains' own frequencies
    move = (gold[:, :-1] * len(labels) + gold[:, 1:])[ids[:, 1:] >= 0]
    move = np.bincount(move, minlength=len(labels) ** 2).reshape(len(labels), len(labels)) + 1.0
    model.transitions[:] = np.log(move / move.sum(1, keepdims=True))
    squares, moved = np.full_like(model.weights, 1e-3), np.full(model.transitions.shape, 1e-1)
    for _ in range(max(epochs, -(-STEPS // -(-len(blocks) // 256)))):
        order = rng.permutation(len(blocks))
        for at in range(0, len(order), 256):
            pick = order[at : at + 256]
            batch, y = ids[pick], gold[pick]
            there = batch >= 0
            used, where = np.unique(batch[there], return_inverse=True)
            spans = [np.arange(starts[u], starts[u + 1]) for u in used]
            owner = np.repeat(np.arange(len(used)), [len(s) for s in spans])
            slots = flat[np.concatenate(spans)] if spans else np.empty(0, np.int64)
            unique = np.stack([np.bincount(owner, model.weights[slots, k], len(used)) for k in range(len(labels))], axis=1)
            scores = np.zeros((*batch.shape, len(labels)), np.float32)
            scores[there] = unique[where]
            gamma, pairs = posteriors(scores, there, model.transitions)
            wrong = -gamma
            wrong[np.arange(len(y))[:, None], np.arange(BLOCK), y] += 1
            errors = wrong[there]
            gradient = np.empty_like(model.weights)
            for k in range(len(labels)):
                by_word = np.bincount(where, errors[:, k], len(used))
                gradient[:, k] = np.bincount(slots, by_word[owner], TABLE) / there.sum()
            squares += gradient**2
            model.weights += 0.1 * gradient / np.sqrt(squares)
            pair = (y[:, :-1] * len(labels) + y[:, 1:])[there[:, 1:]]
            steps = np.bincount(pair, minlength=len(labels) ** 2).reshape(len(labels), len(labels))
            difference = (steps - pairs) / max(1, there.sum())
            moved += difference**2
            model.transitions += (0.1 * difference / np.sqrt(moved)).astype(np.float32)
    return model


def training_sample(docs: DataFrame, per_language: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """text and lang of about per_language rows of each language, never more than per_language * languages."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "text is not null and lang is not null"
    )
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return known.select("text", "lang").limit(0)
    digest = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, per_language / n))])
    return known.where(place < share[F.col("lang")]).orderBy(digest, "id").limit(per_language * len(counts)).select("text", "lang")


def train(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE, id_col="doc_id", text_col="text", lang_col="lang") -> Crf:
    sample = training_sample(docs, per_language, id_col, text_col, lang_col).toPandas()
    return fit(sample["text"].tolist(), sample["lang"].tolist())


def identify(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text", more: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: the id, the columns `more`, lang_pred and score.

    Null texts and texts without a letter get `und` and score 0, as does all text
    where the model has no label. Whole texts are read; repeated rows and null ids
    give a row each; other columns are ignored.
    """
    more = more or {}

    def predict(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts, at, found = batch.column(0).to_pylist(), 0, []
            while at < len(texts):  # a part of the batch at a time, by characters
                size, stop = 0, at
                while stop < len(texts) and (stop == at or size + len(texts[stop] or "") < 1_000_000):
                    size += len(texts[stop] or "")
                    stop += 1
                found += model.languages(texts[at:stop])
                at = stop
            predicted = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            arrays = [batch.column(i) for i in range(1, batch.num_columns)] + predicted
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "lang_pred", "score"])

    names = ["id", *(f"m{i}" for i in range(len(more)))]
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"), *[c.alias(n) for c, n in zip(more.values(), names[1:])])
    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names) + ", lang_pred string, score double"
    return rows.mapInArrow(tidy(predict), schema).toDF(id_col, *more, "lang_pred", "score")


def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = train(docs.where(~held_out))
    return identify(docs, model, more={"held_out": held_out})


QUERIES = {"op8_crf_language": op8}
ORACLES: dict[str, str] = {}
