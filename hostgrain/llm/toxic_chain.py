"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another; each later model also sees the
earlier categories' probabilities. While training, those come from models that
have not seen the row (out-of-fold), so that a later model meets the same kind of
input as it does when predicting. Training uses a bounded sample of labelled
rows; features are words and beginnings of words (CRC-32 in lower case) and a few
shape figures, of which a model keeps the words that plainly tell the classes apart.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostgrain.llm.storage import table, tidy

#: Labelled rows to train on, at most: those with the smallest digests of their id.
MAX_LABELLED = 6_000
#: Word features of a model, at most.
MAX_WORDS = 400
#: Least gain in log-likelihood of a word feature: noise among millions of candidates stays below.
MIN_GAIN = 20.0
#: Lengths of the beginnings of words that count as features: stems of a language whose words are inflected.
STEMS = (4, 5)
FOLDS = 3
THRESHOLD = 0.3
#: Penalty of the squared weights: with few toxic rows, words that occur in toxic rows by chance stay weak.
RIDGE = 1.0
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…¡¿–—"


def word_codes(text: str) -> set[int]:
    """A code for each distinct word of the text and each stem, in lower case and without marks around the word."""
    words = {w.strip(_EDGES) for w in set(text.lower().split())}
    words.discard("")
    for n in STEMS:
        words |= {f"^{w[:n]}" for w in words if len(w) > n and w[0] != "^"}
    return {zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words}


def shape(text: str) -> list[float]:
    """Figures about the form of a text: length, variety of words, share of letters, repeated lines."""
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    letters = sum(map(str.isalpha, text)) / max(1, len(text))
    return [np.log1p(len(words)), len(set(words)) / n, letters, len(set(lines)) / len(lines), min(30.0, len(text) / n)]


@dataclass
class Linear:
    """A logistic model of word codes and further figures."""

    words: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def inputs(self, codes: list, more: np.ndarray) -> np.ndarray:
        place = {int(w): i for i, w in enumerate(self.words)}
        x = np.zeros((len(codes), len(place) + more.shape[1] + 1))
        for i, c in enumerate(codes):
            known = place.keys() & c if isinstance(c, set) else np.intersect1d(self.words, c, assume_unique=True).tolist()
            x[i, [place[w] for w in known]] = 1
        x[:, len(place) : -1] = (more - self.mean) / self.scale
        x[:, -1] = 1
        return x

    def predict(self, codes: list, more: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.empty(0)
        return 1 / (1 + np.exp(-np.clip(self.inputs(codes, more) @ self.weights, -30, 30)))


def informative(codes: list[np.ndarray], y: np.ndarray, most: int) -> np.ndarray:
    """The codes that differ most between the classes (G statistic), of those in three rows at least."""
    ids = np.concatenate([*codes, np.empty(0, np.uint32)])
    label = np.repeat(y, [len(c) for c in codes])
    words, where = np.unique(ids, return_inverse=True)
    pos = np.bincount(where, label, len(words))
    all_ = np.bincount(where, minlength=len(words))
    p, q = (pos + 0.5) / (y.sum() + 1), (all_ - pos + 0.5) / ((1 - y).sum() + 1)
    gain = np.where(all_ >= 3, pos * np.log(p / q) + (all_ - pos) * np.log(q / p), -np.inf)
    best = np.lexsort((words, -gain))[:most]
    return np.sort(words[best[gain[best] > MIN_GAIN]])


def fit_linear(codes: list[np.ndarray], more: np.ndarray, y: np.ndarray, most: int = MAX_WORDS, ridge: float = RIDGE) -> Linear:
    """Newton's method on the ridge-penalised likelihood; one class only gives a constant."""
    model = Linear(informative(codes, y, most), more.mean(0), more.std(0) + 1e-6, np.empty(0))
    x = model.inputs(codes, more)
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty * w)
        w += step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-4:
            break
    model.weights = w
    return model


def fit_chain(codes: list[np.ndarray], figures: np.ndarray, labels: np.ndarray, folds: int = FOLDS) -> list[Linear]:
    """A model for each column of labels, in order; the inputs of each have the columns before as probabilities."""
    chain, earlier = [], np.empty((len(codes), 0))
    fold = np.arange(len(codes)) % folds
    for k in range(labels.shape[1]):
        y, more = labels[:, k].astype(float), np.hstack([figures, earlier])
        held_out = np.zeros(len(codes))
        for f in range(folds):
            train, rest = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if len(train) and len(rest):
                part = fit_linear([codes[i] for i in train], more[train], y[train])
                held_out[rest] = part.predict([codes[i] for i in rest], more[rest])
        chain.append(fit_linear(codes, more, y))
        earlier = np.hstack([earlier, held_out[:, None]])
    return chain


def predict_chain(chain: list[Linear], codes: list[set], figures: np.ndarray) -> np.ndarray:
    earlier = np.empty((len(codes), 0))
    for model in chain:
        earlier = np.hstack([earlier, model.predict(codes, np.hstack([figures, earlier]))[:, None]])
    return earlier


def train(docs: DataFrame, labels: DataFrame, categories: list[str], max_labelled: int = MAX_LABELLED, id_col="doc_id", text_col="text") -> list[Linear]:
    """The chain for the 0/1 columns `categories` of labels. Rows with a null label, id or text don't train.

    The sample is bounded by max_labelled, in order of a digest of the id; only
    the codes of its words come to the driver. Of labels that share an id the
    smallest counts, of texts that share one the text with the smallest digest, so
    that reruns train alike.
    """
    known = labels.select(F.col(id_col).alias("label_id"), *[F.col(c).cast("int").alias(f"y{i}") for i, c in enumerate(categories)])
    ys = [f"y{i}" for i in range(len(categories))]
    sample = known.dropna().groupBy("label_id").agg(F.min(F.struct(*ys)).alias("y")).select("label_id", "y.*").orderBy(F.md5(F.col("label_id").cast("string"))).limit(max_labelled)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    joined = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))  # max_labelled rows at most
    # one text for each id, where the rows are: a repeated row is left out before anything is shuffled
    joined = joined.groupBy("label_id", *ys).agg(F.min_by("text", F.sha2("text", 256)).alias("text"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["codes"] = [np.array(sorted(word_codes(t)), np.uint32).view(np.int32) for t in batch["text"]]
            batch["figures"] = [shape(t) for t in batch.pop("text")]
            yield batch

    schema = f"label_id long, {', '.join(f'{y} int' for y in ys)}, codes array<int>, figures array<double>"
    rows = joined.select("label_id", *ys, "text").mapInPandas(tidy(features), schema).toPandas()
    rows = rows.sort_values("label_id")
    if rows.empty:
        return []
    codes = [np.asarray(c, np.int32).view(np.uint32) for c in rows["codes"]]
    return fit_chain(codes, np.array(rows["figures"].tolist()), rows[ys].to_numpy())


def classify(docs: DataFrame, labels: DataFrame, categories: list[str], threshold: float = THRESHOLD, id_col="doc_id", text_col="text", keep: list[str] | None = None, **options) -> DataFrame:
    """One row per input row: the columns `keep` (id), a probability p_<category> each, and `rejected`.

    rejected: the last category's probability reaches the threshold. Null and
    empty texts have probability 0 and stay, as does everything where there are
    no labels to learn from. Repeated rows get equal results; whole texts are read.
    """
    chain = train(docs, labels, categories, id_col=id_col, text_col=text_col, **options)
    keep = [id_col] if keep is None else keep
    names = [f"p_{c}" for c in categories]

    def predict(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("__text"))
            p = np.zeros((len(texts), len(names)))
            for at in range(0, len(texts) if chain else 0, 200):  # the words of some texts at a time
                some = [t or "" for t in texts.slice(at, 200).to_pylist()]
                codes = [word_codes(t) for t in some]
                p[at : at + 200] = predict_chain(chain, codes, np.array([shape(t) for t in some]))
                p[[at + i for i, c in enumerate(codes) if not c]] = 0
            arrays = [batch.column(i) for i in range(len(keep))] + [pa.array(p[:, k]) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(p[:, -1] >= threshold)], names=[*kept_names, *names, "rejected"])

    kept_names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, kept_names)], F.col(text_col).alias("__text"))
    schema = ", ".join([f"{n} {rows.schema[n].dataType.simpleString()}" for n in kept_names] + [f"{n} double" for n in names] + ["rejected boolean"])
    return rows.mapInArrow(tidy(predict), schema).toDF(*keep, *names, "rejected")


def toxicity(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """classify() with the chain low quality, toxic."""
    known = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), F.col("toxic"))
    return classify(docs, known, ["low_quality", "toxic"], keep=keep)


def op9(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op9_toxic_chain": op9}
ORACLES: dict[str, str] = {}
