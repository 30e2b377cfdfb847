"""URLs judged by rules and, where no rule fits, by the ratio of two character models.

Rules are hosts with paths; a rule fits its host and all subdomains of it, if the URL's path starts with the rule's, and of
several the longest wins. URLs with an allow rule are the accepted ones, those with a block rule the rejected ones. Each
class has a variable-order Markov model of its characters: the probability of a character is taken from the longest
context of up to ORDER characters that was seen, smoothed with that of the next shorter one in proportion to the different
characters that followed it (Witten-Bell), down to a uniform distribution over all characters and the URL's end.

A URL's score is the difference of its log-likelihoods in both models, divided by its length with the end. The limit is
calibrated on every fifth labelled URL, which the models do not see: of all limits the one that gets the largest mean of
the classes' shares right; of several the middle of the widest run. URLs at the limit or above are allowed.

Counts are taken by Spark over all distinct labelled URLs and kept whole. Tasks hold a part of them of bounded size: the most
frequent contexts of both classes, each with all its entries, MODEL_ENTRIES entries (of at most 24 bytes) together. While that is
all there is, tasks score by themselves. Beyond it they score the characters whose contexts are all at hand; the others are
looked up: the different strings of a character and those before it (grams) are joined with the counts, their probabilities
follow from the shorter gram's, order by order, and each URL's looked-up characters are joined and added to its own. So every
score is that of the whole models, whatever their size.

Defined results: a null URL is the empty text. A URL without `://` has an empty host and an empty path, fits no rule and
is judged by the models as it stands. Without labelled URLs of both classes there is nothing to tell apart and every URL
without a rule is allowed (score 0). Repeated URLs get equal results and are learnt once; very long ones are cut nowhere.
An empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import frozen, slices, texts

ORDER = 5
MODEL_ENTRIES = 400_000
# Every FOLDS-th labelled URL, by its checksum, calibrates the limit.
FOLDS = 5
# Scores are counted in BINS of equal width between -REACH and REACH for the calibration.
BINS, REACH = 4096, 8.0
# Characters handled together inside a task.
PART_BYTES = 250_000

# Code points, and the end of a URL as one symbol more.
END = 0x110000
SYMBOLS = END + 1


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Everything up to the first `://`, then host and path.
_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, _PARTS, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 2)


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):  # the longest is asked first
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.host + rule.path).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


# ---- contexts of characters ------------------------------------------------------------------------------------------

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _symbols(urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All symbols, an end behind each URL, and each symbol's place in its URL."""
    coded = [np.frombuffer(url.encode("utf-32-le", "surrogatepass"), "<u4") for url in urls]
    sizes = np.array([len(c) + 1 for c in coded], np.int64)
    symbols = np.full(int(sizes.sum()), END, np.uint64)
    places = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[places < np.repeat(sizes - 1, sizes)] = np.concatenate(coded) if coded else []
    return symbols, places


def _contexts(symbols: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By rising order: which symbols have a context that long, and its 64-bit hash."""
    before = np.zeros(len(symbols), np.uint64)
    yield np.ones(len(symbols), bool), _mixed(before + np.uint64(1))
    for order in range(1, ORDER + 1):
        shifted = np.zeros_like(symbols)
        shifted[order:] = symbols[:-order] + np.uint64(1)
        before = _mixed(before * _ODD + shifted)
        yield places >= order, _mixed(before + np.uint64(order + 1))


def _entry(context: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    return _mixed(context * _ODD + symbols + np.uint64(7))


_COUNTS = "accepted boolean, context long, entry long, n long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each entry (context and symbol) occurs in the batch, by class."""
    for batch in batches:
        for part in slices(batch, "url", PART_BYTES):
            accepted = part.column("accepted").to_numpy(zero_copy_only=False).astype(bool)
            for kind in (True, False):
                symbols, places = _symbols([u for u, a in zip(texts(part, "url"), accepted, strict=True) if a == kind])
                contexts, entries = [], []
                for inside, context in _contexts(symbols, places):
                    contexts.append(context[inside])
                    entries.append(_entry(context, symbols)[inside])
                entry, first, n = np.unique(np.concatenate(entries), return_index=True, return_counts=True)
                context = np.concatenate(contexts)[first]
                columns = [pa.array(np.full(len(entry), kind)), *(pa.array(x.view(np.int64)) for x in (context, entry, n.astype(np.int64)))]
                yield pa.RecordBatch.from_arrays(columns, names=["accepted", "context", "entry", "n"])


# ---- the models ------------------------------------------------------------------------------------------------------


@dataclass
class Model:
    """Counts of one class by sorted hash: of entries, and of contexts with the different symbols seen in them."""

    entries: np.ndarray
    entry_n: np.ndarray
    contexts: np.ndarray
    context_n: np.ndarray
    context_kinds: np.ndarray

    @classmethod
    def of(cls, context: np.ndarray, entry: np.ndarray, n: np.ndarray) -> Model:
        order = np.argsort(entry)
        contexts, place, kinds = np.unique(context, return_inverse=True, return_counts=True)
        total = np.bincount(place, weights=n, minlength=len(contexts))
        return cls(entry[order], n[order].astype(np.float64), contexts, total, kinds.astype(np.float64))

    def log_likelihoods(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Natural logarithm of each symbol's probability after the symbols before it."""
        return self.found(symbols, places)[0]

    def found(self, symbols: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logarithms, and which symbols have all their contexts here, so that no other count could change them."""
        p, whole = np.full(len(symbols), 1.0 / SYMBOLS), np.ones(len(symbols), bool)
        for inside, context in _contexts(symbols, places):
            at = _place(self.contexts, context)
            whole &= ~inside | (at >= 0)
            known = np.nonzero(inside & (at >= 0))[0]
            at = at[known]
            entry = _place(self.entries, _entry(context[known], symbols[known]))
            seen = np.where(entry >= 0, self.entry_n[entry], 0.0)
            kinds, total = self.context_kinds[at], self.context_n[at]
            p[known] = (seen + kinds * p[known]) / (total + kinds)
        return np.log(p), whole


def _place(ordered: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted hash, -1 where it is missing."""
    at = np.searchsorted(ordered, wanted)
    at[at == len(ordered)] = 0
    return np.where(ordered[at] == wanted, at, -1) if len(ordered) else np.full(len(wanted), -1)


def log_ratios(urls: list[str], accepted: Model, rejected: Model) -> np.ndarray:
    """Length-normalised log-likelihood difference of each URL."""
    symbols, places = _symbols(urls)
    differences = accepted.log_likelihoods(symbols, places) - rejected.log_likelihoods(symbols, places)
    starts = np.nonzero(places == 0)[0]
    if not len(starts):
        return np.zeros(0)
    return np.add.reduceat(differences, starts) / np.diff([*starts, len(symbols)])


def best_limit(accepted: np.ndarray, rejected: np.ndarray) -> float:
    """The limit between two histograms of scores with the best mean share of both classes on their side."""
    below = np.concatenate([[0], np.cumsum(accepted)]) / accepted.sum()
    right = np.concatenate([[0], np.cumsum(rejected)]) / rejected.sum() + 1.0 - below
    best = np.nonzero(right >= right.max() - 1e-12)[0]
    runs = np.split(best, np.nonzero(np.diff(best) > 1)[0] + 1)
    widest = max(runs, key=len)
    return float((widest[0] + widest[-1]) / 2 * (2 * REACH / BINS) - REACH)


def _scored(accepted: Model, rejected: Model):
    """Adds the score to batches whose first column is the URL."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "url", PART_BYTES):
                yield part.append_column("score", pa.array(log_ratios(texts(part, "url"), accepted, rejected), pa.float64()))

    return score


# ---- characters beyond what tasks hold -------------------------------------------------------------------------------


_PARTS_OF_SCORES = "key long, at int, gram long, difference double"
_GRAMS = "longest boolean, place int, context long, gram long, shorter long"


def _beyond(part: pa.RecordBatch, accepted: Model, rejected: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, places, log-likelihood differences, and which of these are not settled by the models at hand."""
    symbols, places = _symbols(texts(part, "url"))
    (good, good_whole), (bad, bad_whole) = accepted.found(symbols, places), rejected.found(symbols, places)
    return symbols, places, good - bad, ~(good_whole & bad_whole)


def _parts_of_scores(accepted: Model, rejected: Model):
    """Per URL a row with the sum of the settled differences (at -1), and a row per symbol whose gram is to be looked up."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "url", PART_BYTES):
                symbols, places, differences, lost = _beyond(part, accepted, rejected)
                gram = np.zeros(len(symbols), np.uint64)
                for inside, context in _contexts(symbols, places):
                    gram = np.where(inside, _entry(context, symbols), gram)
                starts = np.nonzero(places == 0)[0]
                settled = np.add.reduceat(np.where(lost, 0.0, differences), starts)
                keys = part.column("key").to_numpy()
                key = np.repeat(keys, np.diff([*starts, len(symbols)]))[lost]
                columns = [
                    pa.array(np.concatenate([keys, key])),
                    pa.array(np.concatenate([np.full(len(keys), -1), places[lost]]).astype(np.int32)),
                    pa.array(np.concatenate([keys, gram[lost].view(np.int64)])),
                    pa.array(np.concatenate([settled, np.zeros(len(key))]), mask=np.arange(len(keys) + len(key)) >= len(keys)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "at", "gram", "difference"])

    return split


def _grams(accepted: Model, rejected: Model):
    """The different grams of the unsettled symbols: each with its context, the next shorter gram and its order (place)."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "url", PART_BYTES):
                symbols, places, _, lost = _beyond(part, accepted, rejected)
                shorter = np.zeros(len(symbols), np.uint64)
                for order, (inside, context) in enumerate(_contexts(symbols, places)):
                    gram, some = _entry(context, symbols), np.nonzero(inside & lost)[0]
                    longest = np.minimum(places[some], ORDER) == order
                    # A gram may be the longest one of a URL's start and a shorter one elsewhere.
                    _, first, which = np.unique(gram[some], return_index=True, return_inverse=True)
                    some, longest = some[first], np.bincount(which, longest, len(first)) > 0
                    hashes = [pa.array(x[some].view(np.int64)) for x in (context, gram, shorter)]
                    shorter = gram
                    columns = [pa.array(longest), pa.array(np.full(len(some), order, np.int32)), *hashes]
                    yield pa.RecordBatch.from_arrays(columns, names=["longest", "place", "context", "gram", "shorter"])

    return listed


@dataclass
class Filter:
    """The models as far as tasks hold them, all counts where there are more, and the limit; without models every URL passes."""

    accepted: Model | None = None
    rejected: Model | None = None
    limit: float = 0.0
    counts: DataFrame | None = None

    def with_scores(self, urls: DataFrame) -> DataFrame:
        """Adds `score`; `urls` has the URL as text in `url`."""
        if self.accepted is None:
            return urls.withColumn("score", F.lit(0.0))
        if self.counts is None:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema)
            return urls.mapInArrow(_scored(self.accepted, self.rejected), f"{columns}, score double")
        different = urls.select("url", F.xxhash64("url").alias("key")).distinct()
        parts = different.mapInArrow(_parts_of_scores(self.accepted, self.rejected), _PARTS_OF_SCORES)
        values = self._looked_up(different).withColumnRenamed("difference", "found")
        each = F.struct("at", F.when(F.col("at") < 0, F.col("difference")).otherwise(F.col("found")).alias("part"))
        parts_of = parts.join(values, "gram", "left").groupBy("key").agg(F.sort_array(F.collect_list(each)).alias("_parts"))
        total = F.aggregate("_parts", F.lit(0.0), lambda so_far, one: so_far + one["part"])
        scores = parts_of.select(F.col("key").alias("_key"), total.alias("_total"))
        keyed = urls.withColumn("_key", F.xxhash64("url"))
        return keyed.join(scores, "_key").select(*urls.columns, (F.col("_total") / (F.length("url") + 1)).alias("score"))

    def _looked_up(self, urls: DataFrame) -> DataFrame:
        """(gram, difference) of all longest grams that tasks cannot settle, from the counts, order by order."""
        listed = urls.mapInArrow(_grams(self.accepted, self.rejected), _GRAMS)
        one = listed.groupBy("place", "gram", "context", "shorter").agg(F.max("longest").alias("longest"))
        wanted = frozen(one, "url-grams")
        of_context, of_entry = [], []
        for kind, name in ((F.col("accepted"), "good"), (~F.col("accepted"), "bad")):
            of_context += [F.sum(F.when(kind, F.col("n"))).alias(f"{name}_total"), F.count_if(kind).alias(f"{name}_kinds")]
            of_entry.append(F.sum(F.when(kind, F.col("n"))).alias(f"{name}_n"))
        contexts = self.counts.groupBy("context").agg(*of_context)
        entries = self.counts.groupBy(F.col("entry").alias("gram")).agg(*of_entry)
        numbers = [f"{name}_{number}" for name in ("good", "bad") for number in ("n", "total", "kinds")]
        counted = frozen(wanted.join(contexts, "context", "left").join(entries, "gram", "left").na.fill(0, numbers), "url-gram-counts")
        levels: list[DataFrame] = []
        for order in range(ORDER + 1):
            level = counted.where(F.col("place") == order)
            if levels:
                before = levels[-1].select(F.col("gram").alias("shorter"), F.col("good").alias("good_p"), F.col("bad").alias("bad_p"))
                level = level.join(before, "shorter")
            else:
                level = level.select("*", *[F.lit(1.0 / SYMBOLS).alias(p) for p in ("good_p", "bad_p")])
            chances = [F.expr(f"CASE WHEN {k}_kinds > 0 THEN ({k}_n + {k}_kinds * {k}_p) / ({k}_total + {k}_kinds) ELSE {k}_p END").alias(k) for k in ("good", "bad")]
            levels.append(frozen(level.select("gram", "longest", *chances), "url-gram-chances"))
        settled = reduce(DataFrame.unionByName, levels).where("longest")
        return settled.select("gram", (F.ln("good") - F.ln("bad")).alias("difference"))


def _at_hand(counts: DataFrame, entries: int) -> DataFrame:
    """The counts of the most frequent contexts with all their entries, at most `entries` together."""
    contexts = counts.groupBy("accepted", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    first = contexts.orderBy(F.desc("total"), "accepted", "context").limit(entries).toArrow()
    fits = int((np.cumsum(first.column("kinds").to_numpy()) <= entries).sum())
    chosen = counts.sparkSession.createDataFrame(first.slice(0, fits).select(["accepted", "context"]))
    return counts.join(F.broadcast(chosen), ["accepted", "context"], "left_semi")


def trained_filter(labelled: DataFrame, entries: int = MODEL_ENTRIES) -> Filter:
    """Models and limit from labelled URLs (url, accepted); a URL under both labels counts as rejected."""
    urls = labelled.groupBy("url").agg(F.bool_and("accepted").alias("accepted"))
    held_out = F.crc32(F.col("url").cast("binary")) % FOLDS == 1
    found = urls.where(~held_out).mapInArrow(_counted, _COUNTS).groupBy("accepted", "context", "entry").agg(F.sum("n").alias("n"))
    counts = frozen(found, "url-counts")
    sizes = [row["count"] for row in counts.groupBy("accepted").count().collect()]  # at most two
    if len(sizes) < 2:
        return Filter()
    whole = sum(sizes) <= entries
    # At most `entries` rows reach the driver.
    kept = (counts if whole else _at_hand(counts, entries)).toArrow()
    kind = kept.column("accepted").to_numpy(zero_copy_only=False).astype(bool)
    hashes = [kept.column(c).to_numpy().view(np.uint64) for c in ("context", "entry")]
    n = kept.column("n").to_numpy()
    models = [Model.of(hashes[0][kind == k], hashes[1][kind == k], n[kind == k]) for k in (True, False)]
    chosen = Filter(*models, counts=None if whole else counts)
    bin_ = F.floor((F.col("score") + REACH) * (BINS / (2 * REACH)))
    scored = chosen.with_scores(urls.where(held_out))
    seen = scored.groupBy("accepted", F.greatest(F.lit(0), F.least(F.lit(BINS - 1), bin_)).alias("bin")).count()
    histograms = {True: np.zeros(BINS), False: np.zeros(BINS)}
    for row in seen.collect():  # at most two classes times BINS
        histograms[row["accepted"]][row["bin"]] = row["count"]
    if histograms[True].sum() and histograms[False].sum():
        chosen.limit = best_limit(histograms[True], histograms[False])
    return chosen


def judge(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    parts = pages.select("page_id", url.alias("url")).select("*", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    ruled = parts.select("*", rule.alias("rule"), verdict.alias("ruled"))
    chosen = trained_filter(ruled.where("ruled IS NOT NULL").select("url", (F.col("ruled") == "allow").alias("accepted")))
    modelled = F.when(F.col("score") >= chosen.limit, "allow").otherwise("block")
    scored = chosen.with_scores(ruled)
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", modelled).alias("verdict"), "score")
