"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. The model of each is a logistic
regression on the words of a text and on the probabilities of all earlier categories.
In training these are out-of-fold: each row's come from models that did
not see it, as later rows' will. The threshold of each category is the one with the best F1
on its own out-of-fold probabilities.

Words are runs of letters, digits and characters from U+0080 with A-Z in
lower case, known by 64-bit hashes. Besides the words, their beginnings of 3 to 6 characters
count, which pool the evidence of rare forms. Each counts once for each text. A word or
beginning is left to the regression if its share among the positive training texts
differs from that among the others by at least ``MIN_Z`` standard errors, however few texts
hold it and however many there are; weight decay, a normal prior, keeps the weights of rare ones small.

The model is fitted on the driver to at most ``SAMPLE`` labelled rows, chosen by hash
of the id, of which the first count whose texts have ``SAMPLE_CHARACTERS`` together; so
what the driver holds has a bound, however long texts are. Texts train as a whole, equal ones once. Prediction reads all whole texts in
tasks, without a shuffle. Null and empty texts have no words and get the model's base
rate. Labelled ids without a document, null labels and rows without an id do not
train. Without any training row, probabilities are 0. Repeated rows get equal results;
extra columns are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.llm.decontam import IS_WORD
from edgeloom.llm.textblocks import lean, mix, row_blocks, runs, utf8, word_hashes
from edgeloom.storage import keep

SAMPLE = 8000
FOLDS = 5
BEGINNINGS = (3, 4, 5, 6)
MIN_Z = 3.0
SAMPLE_CHARACTERS = 2**25
ROUNDS, RATE, DECAY = 150, 0.2, 2.0
COLUMN = "__toxicity"


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and beginnings of words of each row, with repeats, and their rows."""
    starts, ends, rows = runs(IS_WORD[data], offsets)
    characters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first = np.searchsorted(characters, starts)
    stops = np.repeat(ends[:, None], 1 + len(BEGINNINGS), axis=1)
    for i, size in enumerate(BEGINNINGS, 1):
        stops[:, i] = np.minimum(ends, characters[np.minimum(first + size, len(characters) - 1)])
    hashes = word_hashes(data, np.repeat(starts, stops.shape[1]), stops.ravel()).reshape(stops.shape)
    # A beginning is not the word of the same letters; a short word has none of its own.
    return np.where(stops < ends[:, None], mix(hashes), hashes).ravel(), np.repeat(rows, stops.shape[1])


def distinct_words(column: pa.Array, marks: np.ndarray | None = None):
    """For each row its distinct features; with ``marks`` only those whose first 16 bits are marked."""
    all_data, all_offsets = utf8(column)
    for first, last in row_blocks(all_offsets):
        offsets = all_offsets[first : last + 1]
        data, offsets = all_data[offsets[0] : offsets[-1]], offsets - offsets[0]
        hashes, rows = _features(data, offsets)
        if marks is not None:
            maybe = marks[hashes >> np.uint64(48)]
            hashes, rows = hashes[maybe], rows[maybe]
        cuts = np.searchsorted(rows, np.arange(last - first + 1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield np.unique(hashes[a:b])


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


@dataclass
class Linear:
    """One link of the chain: words with weights, weights of earlier links, bias."""

    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def scores(self, hashes: np.ndarray, rows: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Probability of each row from its distinct words and earlier probabilities."""
        total = np.full(len(before), self.bias)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            true = self.words[at] == hashes
            total += np.bincount(rows[true], self.weights[at[true]], len(before))
        return _sigmoid(total + _logit(before) @ self.earlier)


def _select(codes: np.ndarray, rows: np.ndarray, truth: np.ndarray, size: int) -> np.ndarray:
    """Numbers below ``size`` of the words that tell positive from negative texts, sorted."""
    inside = np.bincount(codes, truth[rows], size)
    total = np.bincount(codes, minlength=size)
    n, positive = len(truth), max(truth.sum(), 1)
    share = total / max(n, 1)
    error = np.sqrt(share * (1 - share) * (1 / positive + 1 / max(n - positive, 1))) + 1e-12
    z = (inside / positive - (total - inside) / max(n - positive, 1)) / error
    return np.flatnonzero(np.abs(z) >= MIN_Z)


def fit_linear(
    codes: np.ndarray, rows: np.ndarray, before: np.ndarray, truth: np.ndarray, known: np.ndarray
) -> Linear:
    """Logistic regression with weight decay, by Adam on all rows at once.

    ``codes`` are places in ``known``, the sorted hashes of all words.
    """
    words = _select(codes, rows, truth, len(known))
    n, k = len(truth), len(words)
    place = np.full(len(known), -1)
    place[words] = np.arange(k)
    at = place[codes]
    at, owner = at[at >= 0], rows[at >= 0]
    links = _logit(before)
    values = np.zeros(k + links.shape[1] + 1)
    base = (truth.sum() + 0.5) / (n + 1)
    values[-1] = _logit(base)
    first, second = np.zeros_like(values), np.zeros_like(values)
    scale = np.concatenate([np.maximum(np.bincount(at, minlength=k), 1), np.full(len(values) - k, max(n, 1))])
    for step in range(1, ROUNDS + 1):
        total = np.bincount(owner, values[at], n) + links @ values[k:-1] + values[-1]
        error = truth - _sigmoid(total)
        slope = np.concatenate(
            [np.bincount(at, error[owner], k), links.T @ error, [error.sum()]]
        ) / scale
        slope[:-1] -= DECAY / scale[:-1] * values[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        values += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Linear(known[words], values[:k], values[k:-1], float(values[-1]))


@dataclass
class Chain:
    categories: list[str]
    links: list[Linear]
    thresholds: list[float]

    def probabilities(self, hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        found = np.zeros((n, len(self.links)))
        for i, link in enumerate(self.links):
            found[:, i] = link.scores(hashes, rows, found[:, :i])
        return found


def _best_threshold(probability: np.ndarray, truth: np.ndarray) -> float:
    """Threshold of best F1, halfway to the next lower probability."""
    order = np.argsort(-probability, kind="stable")
    p, hits = probability[order], np.cumsum(truth[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + max(truth.sum(), 1))
    f1[:-1][p[:-1] == p[1:]] = -1  # equal probabilities stay together
    best = int(f1.argmax())
    return float((p[best] + p[best + 1]) / 2) if best + 1 < len(p) else float(p[best])


def fit(categories: list[str], words: list[np.ndarray], truth: np.ndarray, folds: int = FOLDS) -> Chain:
    """Fit the links in order; ``truth`` has a 0/1 column for each category."""
    n = len(words)
    rows = np.repeat(np.arange(n), [len(w) for w in words])
    hashes = np.concatenate([*words, np.empty(0, np.uint64)])
    known, codes = np.unique(hashes, return_inverse=True)
    fold = np.arange(n) % folds
    apart = np.zeros(truth.shape)
    links, thresholds = [], []
    for i in range(len(categories)):
        wanted = truth[:, i].astype(float)
        for f in range(folds if n >= folds else 0):
            seen = np.flatnonzero(fold != f)
            place = np.full(n, -1)
            place[seen] = np.arange(len(seen))
            use = place[rows] >= 0
            model = fit_linear(codes[use], place[rows[use]], apart[seen, :i], wanted[seen], known)
            out = np.flatnonzero(fold == f)
            place = np.full(n, -1)
            place[out] = np.arange(len(out))
            use = place[rows] >= 0
            apart[out, i] = model.scores(hashes[use], place[rows[use]], apart[out, :i])
        links.append(fit_linear(codes, rows, apart[:, :i], wanted, known))
        thresholds.append(_best_threshold(apart[:, i], wanted) if n else 1.0)
    return Chain(categories, links, thresholds)


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    categories: list[str],
    key: str,
    text: str,
    most: int,
    characters: int = SAMPLE_CHARACTERS,
) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct words and labels of at most ``most`` rows and ``characters``, equal texts once."""
    known = labels.where(F.col(key).isNotNull())
    for c in categories:
        known = known.where(F.col(c).isNotNull())
    chosen = (
        known.groupBy(F.col(key).alias("id"))
        .agg(*(F.max(F.col(c).cast("int")).alias(f"c{i}") for i, c in enumerate(categories)))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
    )
    # The limit bounds the broadcast, and the rows of the window; of repeated rows of an id all count.
    sizes = (
        docs.select(F.col(key).alias("id"), F.length(text).alias("size"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id")
        .agg(F.sum("size").alias("size"))
    )
    running = F.sum("size").over(Window.orderBy(F.xxhash64("id"), "id"))
    fits = sizes.withColumn("running", running).where(F.coalesce("running", F.lit(0)) <= characters)
    chosen = keep(chosen.join(fits.select("id"), "id", "left_semi"), "chosen")
    names = [f"c{i}" for i in range(len(categories))]
    found = (
        docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "id")
        .select("id", "text", *names)
    )

    def run(batches):
        for batch in batches:
            words = [w.view(np.int64) for w in distinct_words(batch.column(1))]
            arrays = [batch.column(0), pa.array(words, pa.list_(pa.int64())), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "words", *names])

    schema = ", ".join(["id bigint", "words array<bigint>", *(f"{c} int" for c in names)])
    bags = (
        found.mapInArrow(run, schema)
        .groupBy("words")
        .agg(F.min("id").alias("id"), *(F.max(c).alias(c) for c in names))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
        .toArrow()
    )
    truth = np.array([bags.column(c).to_pylist() for c in names], float).reshape(len(names), -1)
    words = [w.values.to_numpy().view(np.uint64) for w in bags.column("words")]
    return words, truth.T


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: list[str],
    key: str = "doc_id",
    text: str = "text",
    most: int = SAMPLE,
) -> Chain:
    """Fit the chain ``categories`` (0/1 columns of ``labels``) in the given order."""
    return fit(categories, *training_rows(docs, labels, categories, key, text, most))


def score(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """``docs`` with the struct ``__toxicity``: for each category its probability and flag."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    fields = [
        field
        for c in chain.categories
        for field in (T.StructField(f"p_{c}", T.DoubleType()), T.StructField(c, T.BooleanType()))
    ]
    schema = T.StructType([*docs.schema.fields, T.StructField(COLUMN, T.StructType(fields))])
    wanted = np.unique(np.concatenate([*(m.words for m in chain.links), np.empty(0, np.uint64)]))

    def run(batches):
        model = shared.value
        # Most words are none of the model's; a first test on 16 bits finds that out.
        marks = np.zeros(2**16, bool)
        marks[wanted >> np.uint64(48)] = True
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            hashes, rows = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for row, words in enumerate(distinct_words(column, marks)):
                hashes.append(words)
                rows.append(np.full(len(words), row))
            n = batch.num_rows
            found = model.probabilities(np.concatenate(hashes), np.concatenate(rows), n)
            arrays = []
            for i, threshold in enumerate(model.thresholds):
                arrays += [pa.array(found[:, i]), pa.array(found[:, i] >= threshold)]
            column = pa.StructArray.from_arrays(arrays, names=[f.name for f in fields])
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=schema.names)

    return docs.mapInArrow(lean(run), schema)

