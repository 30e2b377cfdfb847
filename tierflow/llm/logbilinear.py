"""Log-bilinear language model, trained with noise-contrastive estimation in numpy, and the unigram score beside it.

Tokens are words and an end. The model's classes are the CLASSES most frequent words, the end, and one class for all other
words; the class of the next token follows from the two classes before it: the vectors of the context, weighted per
position, are summed and multiplied with the vector of the class, plus its bias. A word of the class of others has the
class's probability times its share among them (counts + 0.5).

Training covers every training token. Word counts come from one pass. The training texts are dealt in ROUNDS rounds to groups
of GROUP_TOKENS tokens, a number that follows the tokens and not the files. In a round every group runs noise-contrastive
estimation over its texts, all from the same parameters (at first, biases at the class frequencies); the groups' parameters
and step sizes, averaged by their tokens, begin the next round. So how far a group learns does not depend on how the table
is split, and more data mean more groups, not fewer steps. Scoring needs the normaliser of every context: for two positions it is one matrix product over the
classes, so every probability is normalised exactly.

Words are told by 64-bit hashes. The HEAD most frequent ones, bounded, go to every task; counts of the others are joined,
so base scores are exact for any number of words.

Defined results: a null text is the empty text, its only token is the end. A null id counts as the empty text in the fold
rule and so trains. Every input row gives one output row; repeated rows train as often as they occur. Without training
tokens every count is 0 and the model knows two classes. Words of equal frequency enter the classes by their hash. An empty
table gives an empty result. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import frozen, slices, texts, whole_text

FOLDS, HELD_OUT = 5, 1
CLASSES = 1021
SIZE = 16
HEAD = 300_000
NOISE = 25
BATCH = 1024
RATE = 0.1
ROUNDS = 4
GROUP_TOKENS = 2_000_000
CACHED_WORDS = 500_000
COUNTED_BYTES = 16_000_000

START, END, OTHERS = 0, 1, 2
FIRST_WORD = 3


def key_of(word: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


# No word contains a blank, so the end has a key of its own.
_END_KEY = key_of(b" ")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def held_out() -> Column:
    return (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS) == HELD_OUT


def token_counts(training: DataFrame) -> DataFrame:
    """(key, n) of every training token; a written table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", COUNTED_BYTES):
                held: Counter[bytes] = Counter()
                for text in texts(part, "text"):
                    held.update(words_of(text))
                keys = [_END_KEY, *map(key_of, held)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([part.num_rows, *held.values()], pa.int64())], ["key", "n"])

    found = training.select("text").mapInArrow(count, "key long, n long")
    return frozen(found.groupBy("key").agg(F.sum("n").alias("n")), "token-counts")


@dataclass
class Lexicon:
    """The most frequent words in order of frequency (the end left out), and totals over all training tokens."""

    keys: np.ndarray
    counts: np.ndarray
    ends: int
    tokens: int
    distinct: int
    most: int = CLASSES

    def __post_init__(self):
        self.order = np.argsort(self.keys)
        self.sorted_keys = self.keys[self.order]

    @property
    def words(self) -> int:
        return min(self.most, len(self.keys))

    @property
    def classes(self) -> int:
        return FIRST_WORD + self.words

    def class_counts(self) -> np.ndarray:
        own = self.counts[: self.words]
        return np.concatenate([[0, self.ends, self.tokens - self.ends - own.sum()], own]).astype(float)

    def rank(self, key: int) -> int:
        """The word's place in the order, or -1."""
        at = int(np.searchsorted(self.sorted_keys, key))
        return int(self.order[at]) if at < len(self.keys) and self.sorted_keys[at] == key else -1

    def unigram_log(self) -> float:
        return float(np.log10(self.tokens + 0.5 * (self.distinct + 1)))

    def others_log(self) -> float:
        """The denominator of a word's share among the words without a class of their own."""
        distinct = self.distinct - self.words - (self.ends > 0)
        return float(np.log10(self.class_counts()[OTHERS] + 0.5 * (distinct + 1)))


def lexicon(counts: DataFrame, head: int = HEAD, classes: int = CLASSES) -> Lexicon:
    """Read the head from the counts: whole steps of frequency, as many as fit into `head` words."""
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).orderBy(F.desc("step")).collect()
    room, lowest = head, 1 << 30
    for row in steps:  # a thousand steps at most
        room -= row.words
        if room < 0:
            break
        lowest = row.step
    table = counts.where(step >= lowest).toArrow()
    keys, n = table["key"].to_numpy(), table["n"].to_numpy()
    ends = int(counts.where(F.col("key") == _END_KEY).agg(F.sum("n")).first()[0] or 0)
    keys, n = keys[keys != _END_KEY], n[keys != _END_KEY]
    order = np.lexsort((keys, -n))
    return Lexicon(keys[order], n[order], ends, sum(row.tokens for row in steps), sum(row.words for row in steps), classes)


class Ranks(dict):
    """Place in the lexicon by word, -1 beyond it; bounded."""

    def __init__(self, known: Lexicon):
        self.known = known

    def __missing__(self, word: bytes) -> int:
        rank = self.known.rank(key_of(word))
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = rank
        return rank


@dataclass
class Model:
    """Context vectors, class vectors, biases, and the weights of the two positions (nearest first)."""

    context: np.ndarray
    target: np.ndarray
    bias: np.ndarray
    weights: np.ndarray

    @classmethod
    def start(cls, class_counts: np.ndarray, size: int = SIZE) -> Model:
        random = np.random.default_rng(1)
        shape = (len(class_counts), size)
        share = (class_counts + 0.5) / (class_counts[1:] + 0.5).sum()
        bias = np.log(share)
        bias[START] = -60.0  # the start is never predicted
        return cls(random.normal(0, 0.1, shape), random.normal(0, 0.1, shape), bias, np.ones((2, size)))

    def rows(self) -> np.ndarray:
        """One row per class, and two for the weights: what is averaged."""
        classes = np.column_stack([self.context, self.target, self.bias])
        weights = np.zeros((2, classes.shape[1]))
        weights[:, : self.weights.shape[1]] = self.weights
        return np.vstack([classes, weights])

    @classmethod
    def of_rows(cls, rows: np.ndarray) -> Model:
        size = (rows.shape[1] - 1) // 2
        return cls(rows[:-2, :size], rows[:-2, size : 2 * size], rows[:-2, -1], rows[-2:, :size])

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores of (position, context class, class), the bias with the nearest one, and the log normaliser of contexts."""
        near = (self.context * self.weights[0]) @ self.target.T + self.bias
        far = (self.context * self.weights[1]) @ self.target.T
        near[:, START] = -np.inf
        top_near, top_far = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        product = np.exp(near - top_near) @ np.exp(far - top_far).T  # [nearest, second nearest]
        return np.stack([near, far]).astype(np.float32), (np.log(product) + top_near + top_far.T).astype(np.float32)


def contexts(classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two places before each token; the start before a text's first tokens."""
    near, far = np.roll(classes, 1), np.roll(classes, 2)
    near[starts] = START
    far[starts] = START
    second = starts + 1
    far[second[second < len(classes)]] = START
    return near, far


def _sums(index: np.ndarray, values: np.ndarray, height: int) -> np.ndarray:
    """Rows of `values` added up by index."""
    size = values.shape[1]
    flat = (index[:, None] * size + np.arange(size)).ravel()
    return np.bincount(flat, values.ravel(), height * size).reshape(height, size)


class Trainer:
    """Noise-contrastive estimation with Adagrad steps. The noise words of a batch are shared by its tokens."""

    def __init__(self, model: Model, class_counts: np.ndarray, seed: int):
        self.model, self.random = model, np.random.default_rng(seed)
        share = class_counts + 0.5
        share[START] = 0
        self.share = share / share.sum()
        self.cumulative = np.cumsum(self.share)
        with np.errstate(divide="ignore"):
            self.log_noise = np.log(NOISE * self.share)
        self.squares = [np.full_like(x, 1e-6) for x in (model.context, model.target, model.bias, model.weights)]
        self.tokens = 0

    def step(self, near: np.ndarray, far: np.ndarray, target: np.ndarray) -> None:
        m, height = self.model, len(self.share)
        noise = np.minimum(np.searchsorted(self.cumulative, self.random.random(NOISE)), height - 1)
        expected = m.context[near] * m.weights[0] + m.context[far] * m.weights[1]
        true = np.einsum("ij,ij->i", expected, m.target[target]) + m.bias[target] - self.log_noise[target]
        false = expected @ m.target[noise].T + m.bias[noise] - self.log_noise[noise]
        pull = 1 / (1 + np.exp(np.clip(true, -30, 30)))
        push = -1 / (1 + np.exp(-np.clip(false, -30, 30)))
        back = pull[:, None] * m.target[target] + push @ m.target[noise]
        d_target = _sums(target, pull[:, None] * expected, height)
        np.add.at(d_target, noise, push.T @ expected)
        d_bias = np.bincount(target, pull, height)
        np.add.at(d_bias, noise, push.sum(axis=0))
        d_context = _sums(near, back * m.weights[0], height) + _sums(far, back * m.weights[1], height)
        d_weights = np.stack([(m.context[near] * back).sum(axis=0), (m.context[far] * back).sum(axis=0)])
        for value, gradient, squares in zip((m.context, m.target, m.bias, m.weights), (d_context, d_target, d_bias, d_weights), self.squares, strict=True):
            gradient /= len(target)
            squares += gradient**2
            value += RATE * gradient / np.sqrt(squares)
        self.tokens += len(target)


def _ranks(known: Lexicon) -> Ranks:
    """The places found so far in this worker; the tasks of a worker share a broadcast lexicon, and so what they found in it."""
    return known.__dict__.setdefault("_found", Ranks(known))


def _encoded(part: pa.RecordBatch, ranks: Ranks) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """Ranks of all tokens of some texts in a row (-2 for the end), the place of each text's first one, and the words."""
    words = [words_of(text) for text in texts(part, "text")]
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    starts = np.cumsum(lengths) - lengths
    found = np.full(int(lengths.sum()), -2, np.int64)
    for start, own in zip(starts.tolist(), words, strict=True):
        found[start : start + len(own)] = np.fromiter(map(ranks.__getitem__, own), np.int64, len(own))
    return found, starts, words


def _classes(ranks: np.ndarray, words: int) -> np.ndarray:
    return np.where(ranks == -2, END, np.where((ranks >= 0) & (ranks < words), ranks + FIRST_WORD, OTHERS))


def _learnt(texts_: DataFrame, known, class_counts: np.ndarray, model: Model, squares: Model, number: int) -> tuple[Model, Model] | None:
    """One round: each task learns from its texts; the mean of the tasks' parameters and squares by their tokens."""
    width = 2 * (2 * SIZE + 1)
    begin = np.hstack([model.rows(), squares.rows()])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, task = _ranks(known.value), TaskContext.get().partitionId()
        first, second = (Model.of_rows(half.copy()) for half in np.hsplit(begin, 2))
        trainer = Trainer(first, class_counts, ROUNDS * task + number)
        trainer.squares = [second.context, second.target, second.bias, second.weights]
        for batch in batches:
            for part in slices(batch, "text"):
                found, starts, _ = _encoded(part, ranks)
                classes = _classes(found, known.value.words)
                near, far = contexts(classes, starts)
                order = trainer.random.permutation(len(classes))
                for at in range(0, len(order), BATCH):
                    some = order[at : at + BATCH]
                    trainer.step(near[some], far[some], classes[some])
        if trainer.tokens:
            rows = np.hstack([trainer.model.rows(), Model(*trainer.squares).rows()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(rows))), pa.array([trainer.tokens] * len(rows), pa.int64()), pa.array(list(rows), pa.list_(pa.float64()))],
                ["row", "tokens", "values"],
            )

    each = texts_.mapInArrow(learn, "row long, tokens long, values array<double>")
    cells = each.select("row", "tokens", F.posexplode("values").alias("place", "value"))
    mean = (F.sum(F.col("value") * F.col("tokens")) / F.sum("tokens")).alias("value")
    table = cells.groupBy("row", "place").agg(mean).toArrow()  # a number per parameter
    if not table.num_rows:
        return None
    values = np.zeros((len(class_counts) + 2, width))
    values[table["row"].to_numpy(), table["place"].to_numpy()] = table["value"].to_numpy()
    first, second = np.hsplit(values, 2)
    return Model.of_rows(first), Model.of_rows(second)


def train(training: DataFrame, known: Lexicon) -> Model:
    """All training texts in ROUNDS rounds, dealt evenly to groups of GROUP_TOKENS tokens."""
    shared = training.sparkSession.sparkContext.broadcast(known)
    class_counts = known.class_counts()
    groups = max(1, -(-known.tokens // GROUP_TOKENS))
    model = Model.start(class_counts)
    squares = Model(*[np.full_like(x, 1e-6) for x in (model.context, model.target, model.bias, model.weights)])
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))
    for number in range(ROUNDS):
        dealt = training.where(turn == number).select("text").repartition(groups)
        learnt = _learnt(dealt, shared, class_counts, model, squares, number)
        model, squares = learnt or (model, squares)
    return model


_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, known long, head double, others double, model double, n_others long, keys array<long>, counts array<long>"


def _scored(documents: DataFrame, known: Lexicon, model: Model) -> DataFrame:
    """Per row what the head and the model give, and keys and counts of its words beyond the head."""
    scores, normaliser = model.tables()
    logs = np.log10(known.counts + 0.5)
    shared = documents.sparkSession.sparkContext.broadcast((known, logs, scores, normaliser))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logs, scores, normaliser = shared.value
        ranks, end_log = _ranks(known), float(np.log10(known.ends + 0.5))
        for batch in batches:
            for part in slices(batch, "text"):
                found, starts, words = _encoded(part, ranks)
                classes = _classes(found, known.words)
                near, far = contexts(classes, starts)
                chance = (scores[0, near, classes] + scores[1, far, classes] - normaliser[near, far]) / np.log(10)
                in_head = found >= 0
                each = np.where(in_head, logs[found] if len(logs) else 0.0, np.where(found == -2, end_log, 0.0))
                beyond = np.where(in_head & (found >= known.words), each, 0.0)
                tails = [Counter(key_of(w) for w, r in zip(own, found[s : s + len(own)].tolist(), strict=True) if r == -1) for s, own in zip(starts.tolist(), words, strict=True)]
                sums = [np.add.reduceat(x, starts).astype(float) for x in (each, beyond, chance.astype(np.float64))]
                counted = np.add.reduceat((in_head | ((found == -2) & (known.ends > 0))).astype(np.int64), starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array([len(w) + 1 for w in words], pa.int64()),
                        pa.array(counted),
                        *map(pa.array, sums),
                        pa.array(np.add.reduceat((classes == OTHERS).astype(np.int64), starts)),
                        pa.array([list(t.keys()) for t in tails], pa.list_(pa.int64())),
                        pa.array([list(t.values()) for t in tails], pa.list_(pa.int64())),
                    ],
                    [field.split()[0] for field in _SCORED.split(", ")],
                )

    return frozen(documents.mapInArrow(score, _SCORED), "scored")


def score_documents(documents: DataFrame, head: int = HEAD, classes: int = CLASSES) -> DataFrame:
    """Per row the fold, tokens, known tokens, training tokens, the unigram score and the model's score (log10)."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), held_out().alias("held_out")
    )
    training = rows.where(~F.col("held_out"))
    counts = token_counts(training)
    known = lexicon(counts, head, classes)
    scored = _scored(rows, known, train(training, known))
    each = scored.select("row", F.explode(F.arrays_zip("keys", "counts")).alias("word")).select("row", F.col("word.keys").alias("key"), F.col("word.counts").alias("times"))
    met = each.join(counts, "key", "left")
    tails = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("tail"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known"),
    )
    whole = scored.drop("keys", "counts").join(tails, "row", "left").na.fill(0, ["tail", "tail_known"])
    share = known.others_log()
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.col("tail_known")).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("head") + F.col("tail") - F.col("n_tokens") * known.unigram_log()).alias("base_score"),
        (F.col("model") + F.col("others") + F.col("tail") - F.col("n_others") * share).alias("score"),
    )
