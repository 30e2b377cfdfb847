"""Toxicity by a classifier chain over words.

The chain predicts categories one after the other. Each link is a logistic model on the words of a text plus the
probabilities of the links before it. While a link is trained, those probabilities come from models that have not seen
the text (folds by the id), so a link learns from predictions as good as those it meets later; the model used for
scoring is then fitted on the whole sample.

Training takes at most SAMPLE_ROWS labelled texts, chosen by a hash of the id, and the WORDS words that tell the classes
apart best (chi-square over presence in a text, words in at least MIN_TEXTS texts). That is all the driver holds. Scoring
reads whole texts of all rows.

Defined results: a null text is the empty text; without a known word the probabilities follow from the intercepts. Null
labels and labels of unknown ids are left out; repeated labels of one id count with their largest value, repeated rows of
a labelled id once (the smallest text). Without any labelled text, or with one class only, every probability is the
class's share (0 without rows). Every input row gives one output row. A probability of exactly THRESHOLD counts as toxic.
Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import slices, texts, whole_text

CATEGORIES = ("low_quality", "toxic")
SAMPLE_ROWS = 8_000
WORDS = 400
MIN_TEXTS = 3
FOLDS = 4
BEGINNINGS = (5, 7)
THRESHOLD = 0.5

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    """The words of a text and, marked by a hyphen, their beginnings, which catch inflected and compound forms."""
    bag = set(_WORD.findall(text.lower()))
    for size in BEGINNINGS:
        bag |= {word[:size] + "-" for word in bag if len(word) > size and word[-1] != "-"}
    return bag


@dataclass
class Matrix:
    """Which of the chosen words each text has, as pairs of text and word."""

    rows: np.ndarray
    columns: np.ndarray
    height: int
    width: int

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.columns], self.height)

    def transposed_times(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, values[self.rows], self.width)


@dataclass
class Link:
    """A logistic model: weights of words, of earlier probabilities, and an intercept."""

    words: np.ndarray
    earlier: np.ndarray
    intercept: float


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def predict(link: Link, matrix: Matrix, earlier: np.ndarray) -> np.ndarray:
    return sigmoid(matrix.times(link.words) + earlier @ link.earlier + link.intercept)


def fit(matrix: Matrix, earlier: np.ndarray, labels: np.ndarray, use: np.ndarray, steps: int = 150, decay: float = 1e-4) -> Link:
    """Logistic regression by Adam on the texts in `use`, with weight decay."""
    share = float(np.clip(labels[use].mean() if use.any() else 0.0, 1e-6, 1 - 1e-6))
    width, links = matrix.width, earlier.shape[1]
    params = np.zeros(width + links + 1)
    params[-1] = np.log(share / (1 - share))
    if not use.any() or labels[use].min() == labels[use].max():
        return Link(params[:width], params[width:-1], params[-1])
    m, v = np.zeros_like(params), np.zeros_like(params)
    scale = use / use.sum()
    for step in range(1, steps + 1):
        z = matrix.times(params[:width]) + earlier @ params[width:-1] + params[-1]
        error = (sigmoid(z) - labels) * scale
        gradient = np.concatenate([matrix.transposed_times(error), earlier.T @ error, [error.sum()]])
        gradient[:-1] += decay * params[:-1]
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        params -= 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Link(params[:width], params[width:-1], params[-1])


@dataclass
class Chain:
    """The chosen words by name and the links in the order of the categories."""

    vocabulary: dict[str, int]
    categories: tuple[str, ...]
    links: list[Link]

    def matrix(self, bags: list[set[str]]) -> Matrix:
        pairs = [(i, self.vocabulary[word]) for i, bag in enumerate(bags) for word in bag & self.vocabulary.keys()]
        rows, columns = np.array(pairs, np.int64).reshape(-1, 2).T
        return Matrix(rows, columns, len(bags), len(self.vocabulary))

    def probabilities(self, bags: list[set[str]]) -> np.ndarray:
        """One column per category; each link sees the probabilities before it."""
        matrix = self.matrix(bags)
        known = np.zeros((len(bags), 0))
        for link in self.links:
            known = np.column_stack([known, predict(link, matrix, known)])
        return known


def interned(bags: Iterator[set[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words, and for all bags in a row the text and the word of each entry."""
    codes: dict[str, int] = {}
    arrays = [np.fromiter((codes.setdefault(word, len(codes)) for word in sorted(bag)), np.int32, len(bag)) for bag in bags]
    rows = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays]) if arrays else np.zeros(0, np.int64)
    return list(codes), rows, np.concatenate(arrays) if arrays else np.zeros(0, np.int32)


def choose_words(names: list[str], rows: np.ndarray, words: np.ndarray, labels: np.ndarray, size: int = WORDS, least: int = MIN_TEXTS) -> list[int]:
    """The words (places in `names`) with the largest chi-square against any category; ties by the word."""
    total, n = np.bincount(words, minlength=len(names)).astype(float), max(len(labels), 1)
    best = np.zeros(len(names))
    for labelled in labels.T:
        positive = np.bincount(words, labelled[rows], len(names))
        share = labelled.mean() if len(labelled) else 0.0
        expected = total * share
        spread = expected * (1 - share) * (1 - total / n)
        best = np.maximum(best, np.where(spread > 0, (positive - expected) ** 2 / np.maximum(spread, 1e-12), 0))
    often = np.flatnonzero(total >= least).tolist()
    return sorted(often, key=lambda k: (-best[k], names[k]))[:size]


def train(ids: list[int], documents: list[str], labels: np.ndarray, categories: tuple[str, ...] = CATEGORIES, folds: int = FOLDS) -> Chain:
    """Fit the chain; `labels` has one column of 0 and 1 per category."""
    names, rows, words = interned(map(words_of, documents))
    labels = np.asarray(labels, float).reshape(len(ids), len(categories))
    chosen = choose_words(names, rows, words, labels)
    chain = Chain({names[k]: column for column, k in enumerate(chosen)}, tuple(categories), [])
    column = np.full(len(names), -1)
    column[chosen] = np.arange(len(chosen))
    known = column[words] >= 0
    matrix = Matrix(rows[known], column[words[known]], len(ids), len(chosen))
    fold = np.array([zlib.crc32(str(i).encode()) % folds for i in ids], np.int64)
    unseen = np.zeros((len(ids), 0))
    for target in labels.T:
        chain.links.append(fit(matrix, unseen, target, np.ones(len(ids), bool)))
        out = np.zeros(len(ids))
        for k in range(folds):
            held = fold == k
            if held.any():
                out[held] = predict(fit(matrix, unseen, target, ~held), matrix, unseen)[held]
        unseen = np.column_stack([unseen, out])
    return chain


def labelled_sample(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[int], list[str], np.ndarray]:
    """At most `rows` labelled texts. The ids are chosen before the texts are read, so no text is moved for others."""
    marks = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic"))
    )
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    labelled = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    found = (
        labelled.join(F.broadcast(chosen), "doc_id")  # at most `rows` ids
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("quality").alias("quality"), F.first("toxic").alias("toxic"))
        .orderBy("doc_id")
        .collect()
    )
    marks = np.array([(1 - min(row.quality, 1), min(row.toxic, 1)) for row in found], float).reshape(-1, 2)
    return [row.doc_id for row in found], [row.text for row in found], marks


def _scores(chain: Chain, part: pa.RecordBatch) -> np.ndarray:
    return chain.probabilities([words_of(text) for text in texts(part, "text")])


def trained_chain(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Chain:
    ids, sample, marks = labelled_sample(documents, labels, rows)
    return train(ids, sample, marks)


def score(documents: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """Per row the probability of each category and whether the last one reaches the threshold."""
    names = [f"p_{name}" for name in chain.categories]
    schema = pa.schema([("doc_id", pa.int64()), *((name, pa.float64()) for name in names), ("toxic", pa.bool_())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                known = _scores(chain, part)
                arrays = [part.column("doc_id"), *map(pa.array, known.T), pa.array(known[:, -1] >= threshold)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    columns = ", ".join(["doc_id long", *(f"{name} double" for name in names), "toxic boolean"])
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(scored, columns)


def drop_toxic(documents: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose last category stays below the threshold."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(_scores(chain, part)[:, -1] < threshold))

    return documents.mapInArrow(kept, documents.schema)
