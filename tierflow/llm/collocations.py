"""Phrase collocations, mined per language by partitioning (SON).

A phrase found at least `support` times in a language is found, in at least one of the shards that the texts are dealt to,
at least in proportion to that shard's words. So:

1. Texts are cut into words once and written as coded parts: numbers of words, with the list of the part's words. Every part
   belongs to one of SHARDS shards, the parts of one task to the same.
2. Every shard is mined completely at its own lowered support, level by level: words, then pairs of locally frequent words,
   then longer phrases whose pairs are all locally frequent. A shard is a fixed share of the parts, not what one task holds:
   its counts come from as many tasks as its parts fill, so the local support stays a tenth of the whole one at every
   size, and no task or driver holds a shard.
3. The locally frequent phrases of all shards are united.
4. Every candidate is counted in the whole corpus, as text, which gives exact numbers.

Mining works on 48-bit hashes; equal hashes of different phrases can only add a candidate. Tasks learn which phrases are
frequent from a bitmap of hashes with a bounded size (FILTER_BITS at most, 32 MB); a full bitmap lets more phrases be
counted, never fewer. Partial counts leave a task as one row per part and distinct phrase.

The scores are exact: floor(1000 a n / (l r)) of a cut into l and r in decimals of 38 digits.

Defined results: a null text is empty, a null language is `und`; texts without words give nothing. Repeated rows count
each time. Ties are broken by count, then by the phrase's bytes. Texts are read whole, however long. No documents, or none
with a frequent phrase, give an empty table; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import frozen, slices, texts, whole_text

SUPPORT = 100
WORDS = 5
TOP = 2000
SHARDS = 10
# A longer phrase that holds a candidate hides it when it occurs at least this many times in a hundred of the candidate's.
HIDING = 100
# The bitmaps have about eight bits per phrase, between these bounds.
MIN_FILTER_BITS, FILTER_BITS = 1 << 16, 1 << 28
# Text handled together inside a task.
PART_BYTES = 2_000_000
CODEC = "zstd"
# A language's phrases are ranked in so many parts before the best of each part meet.
RANK_PARTS = 64

# What ends a piece, and what separates words inside one.
BREAKS, SPACES = rb".,;:!?\n\x0b\x0c\r", rb" \t"
_FIND = re.compile(rb"[^" + BREAKS + SPACES + rb"]+|[" + BREAKS + rb"][" + BREAKS + SPACES + rb"]*").findall
_BREAK_BYTES = frozenset(b".,;:!?\n\x0b\x0c\r")
_BREAK = np.zeros(1, "<i4")

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


class _Vocabulary(dict):
    """Number of each word from 1; a break is 0."""

    def __init__(self):
        self.words = [b""]

    def __missing__(self, word: bytes) -> int:
        if word[0] in _BREAK_BYTES:
            number = 0
        else:
            number = len(self.words)
            self.words.append(word)
        self[word] = number
        return number


_CODED = "lang string, shard int, words long, vocabulary_size long, vocabulary binary, numbers_size long, numbers binary"


def _coded(shards: int):
    """Per slice of texts and language one row: its words, and their numbers in order of the text, 0 for a break.

    Both are compressed, so that a batch of rows stays small in the memory of the tasks that read them.
    """
    schema = pa.schema(
        [("lang", pa.string()), ("shard", pa.int32()), ("words", pa.int64())]
        + [field for name in ("vocabulary", "numbers") for field in ((f"{name}_size", pa.int64()), (name, pa.binary()))]
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All parts of a task are of one shard, so that Spark adds up their counts before it shuffles them.
        shard = TaskContext.get().partitionId() % shards
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                by_language: dict[str, tuple[_Vocabulary, list[np.ndarray]]] = {}
                for text, lang in zip(texts(part, "text"), part.column("lang").to_pylist(), strict=True):
                    vocabulary, coded = by_language.setdefault(lang, (_Vocabulary(), []))
                    found = _FIND(text.encode("utf-8", "surrogatepass").lower())
                    coded += [np.fromiter(map(vocabulary.__getitem__, found), "<i4", len(found)), _BREAK]
                for lang, (vocabulary, coded) in by_language.items():
                    numbers = np.concatenate(coded)
                    row = [lang, shard, int(np.count_nonzero(numbers))]
                    for whole in (b"\n".join(vocabulary.words), numbers.tobytes()):
                        row += [len(whole), pa.compress(whole, CODEC, asbytes=True)]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, schema.types, strict=True)], schema=schema)

    return code


class Part:
    """A coded part: the numbers and hashes of its words, and the pieces they stand in."""

    def __init__(self, lang: str, vocabulary: bytes, numbers: bytes):
        coded = np.frombuffer(numbers, "<i4")
        at = np.nonzero(coded)[0]
        self.words = vocabulary.split(b"\n")
        self.numbers = coded[at].astype(np.int64)
        self.pieces = np.cumsum(coded == 0, dtype=np.int32)[at]
        self.language = np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")))
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))[self.numbers]

    def inside(self, k: int) -> np.ndarray:
        """Whether the k words from here stand in one piece."""
        return self.pieces[: max(len(self.pieces) - k + 1, 0)] == self.pieces[k - 1 :]

    def phrases(self, k: int, at: np.ndarray | None = None) -> np.ndarray:
        """48-bit hash of the k words from each place, or from the places `at`, with the language."""
        at = np.arange(max(len(self.hashes) - k + 1, 0)) if at is None else at
        h = np.full(len(at), k, np.uint64)
        for j in range(k):
            h = _mixed(h * _ODD + self.hashes[at + j])
        return _mixed(h ^ self.language) >> np.uint64(16)


# ---- bitmaps ---------------------------------------------------------------------------------------------------------


def _has(filter_: np.ndarray, phrases: np.ndarray, shard: int) -> np.ndarray:
    """Whether the bitmap has the phrases, as a shard sees it."""
    place = (phrases >> np.uint64(2 * shard)) & np.uint64(len(filter_) * 64 - 1)
    return (filter_[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def hash_filter(phrases: DataFrame, by_shard: bool = True) -> np.ndarray:
    """Bitmap of the hashes in `phrases` (shard, phrase), each as its shard sees it or all alike.

    Its size follows their number up to the bound.
    """
    bits = MIN_FILTER_BITS
    wanted = 8 * phrases.count()
    while bits < min(wanted, FILTER_BITS):
        bits *= 2
    shift = "2 * shard" if by_shard else "0"
    place = phrases.select(F.expr(f"shiftrightunsigned(phrase, {shift}) & {bits - 1}L").alias("place"))
    words = place.groupBy(F.expr("CAST(shiftright(place, 6) AS INT)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(place & 63 AS INT)))").alias("bits")
    )
    filled = words.toArrow()  # at most FILTER_BITS / 64 rows of 12 bytes
    bitmap = np.zeros(bits // 64, np.uint64)
    bitmap[filled.column("word").to_numpy()] = filled.column("bits").to_numpy().view(np.uint64)
    return bitmap


# ---- 2. mining the shards --------------------------------------------------------------------------------------------


def _each_part(batches: Iterator[pa.RecordBatch], use: Callable[[Part, dict], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
            whole = [pa.decompress(row[name], row[f"{name}_size"], CODEC, asbytes=True) for name in ("vocabulary", "numbers")]
            part = Part(row["lang"], *whole)
            if len(part.numbers):
                yield use(part, row)


def _local_phrases(shared, first: int, last: int):
    """Counts of the phrases of first to last words all of whose parts the bitmap of shorter ones has; of words, of all."""
    names = ["shard", "phrase", "need", "n"]

    def use(part: Part, row: dict) -> pa.RecordBatch:
        known = None
        if shared is not None:
            known = part.inside(first - 1) & _has(shared.value, part.phrases(first - 1), row["shard"])
        found, counted = [], []
        for k in range(first, last + 1):
            at = part.inside(k)
            if known is not None:
                at = at.copy()
                for j in range(k - first + 2):
                    at &= known[j : j + len(at)]
            phrases, n = np.unique(part.phrases(k, np.nonzero(at)[0]), return_counts=True)
            found.append(phrases)
            counted.append(n)
        phrases, n = np.concatenate(found).view(np.int64), np.concatenate(counted).astype(np.int64)
        columns = [np.full(len(n), row["shard"], np.int32), phrases, np.full(len(n), row["need"], np.int64), n]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    return lambda batches: _each_part(batches, use)


_COUNTED = "shard int, phrase long, need long, n long"


def _frequent(counted: DataFrame) -> DataFrame:
    """The phrases that reach their shard's support."""
    summed = counted.groupBy("shard", "phrase").agg(F.sum("n").alias("n"), F.min("need").alias("need"))
    return summed.where("n >= need").select("shard", "phrase")


# ---- 4. counting the candidates --------------------------------------------------------------------------------------


def _candidate_counts(shared, longest: int):
    """Counts of all phrases that the bitmap of candidates has, as texts."""

    def use(part: Part, row: dict) -> pa.RecordBatch:
        # Numbers stand for whole phrases exactly: pairs of the number of the words before and of the last word.
        count, before, known = len(part.words), part.numbers.copy(), np.ones(len(part.numbers), bool)
        places, times, lengths = [], [], []
        for k in range(1, longest + 1):
            size = max(len(part.numbers) - k + 1, 0)
            if k > 1:
                known = known[:size] & known[1 : size + 1]
            at = np.nonzero(known & part.inside(k))[0]
            at = at[_has(shared.value, part.phrases(k, at), 0)]
            known = np.zeros(size, bool)
            known[at] = True
            keys = before[at] * count + part.numbers[at + k - 1] if k > 1 else before[at]
            _, place, number, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            before = np.zeros(size, np.int64)
            before[at] = number
            places.append(at[place])
            times.append(n)
            lengths.append(np.full(len(n), k))
        at, n, k = np.concatenate(places), np.concatenate(times), np.concatenate(lengths)
        words, numbers = part.words, part.numbers.tolist()
        phrases = [b" ".join([words[x] for x in numbers[i : i + j]]) for i, j in zip(at.tolist(), k.tolist(), strict=True)]
        columns = [
            pa.repeat(pa.scalar(row["lang"], pa.string()), len(n)),
            pa.array(phrases, pa.binary()).cast(pa.string()),
            pa.array(k.astype(np.int32)),
            pa.array(n.astype(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "words", "n"])

    return lambda batches: _each_part(batches, use)


def phrase_counts(documents: DataFrame, support: int = SUPPORT, longest: int = WORDS, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of every phrase of up to `longest` words found `support` times, and (lang, n)."""
    spark = documents.sparkSession
    docs = documents.select(whole_text().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    # A row is one part: few of them go to a Python worker at once.
    parts = frozen(docs.mapInArrow(_coded(shards), _CODED), "coded-texts")
    per_shard = parts.groupBy("lang", "shard").agg(F.sum("words").alias("n"))
    per_language = frozen(per_shard.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"), "languages")
    # A row per language and shard; Spark broadcasts the written table when its size allows it.
    need = F.expr(f"CAST(ceil({support} * CAST(s.n AS DECIMAL(38, 0)) / l.n) AS LONG)")
    needs = frozen(per_shard.alias("s").join(per_language.alias("l"), "lang").select("lang", "shard", need.alias("need")), "supports")
    needed = parts.join(needs, ["lang", "shard"])

    candidates, levels = None, [(1, 1), (2, 2), (3, longest)]
    for first, last in [level for level in levels if level[0] <= min(level[1], longest)]:
        shared = None if candidates is None else spark.sparkContext.broadcast(hash_filter(frequent))
        counted = needed.mapInArrow(_local_phrases(shared, first, last), _COUNTED)
        frequent = frozen(_frequent(counted), f"frequent-{first}")
        candidates = frequent if candidates is None else candidates.unionAll(frequent)
    shared = spark.sparkContext.broadcast(hash_filter(candidates, by_shard=False))
    found = parts.mapInArrow(_candidate_counts(shared, longest), "lang string, phrase string, words int, n long")
    counts = found.groupBy("lang", "phrase").agg(F.max("words").alias("words"), F.sum("n").alias("f")).where(F.col("f") >= support)
    return frozen(counts, "phrases"), per_language


# ---- scores ----------------------------------------------------------------------------------------------------------


def scored(counts: DataFrame, totals: DataFrame, hiding: int = HIDING) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words or more that no longer phrase hides."""
    candidates = counts.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    parts = F.split("phrase", " ")

    def text(start, size):
        return F.array_join(F.slice(parts, start, size), " ")

    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), s -> "
        "array_join(slice(split(phrase, ' '), s, m), ' '))))"
    )
    hidden = candidates.where("words >= 3").select("lang", F.explode(inner).alias("phrase"), "a")
    hidden = hidden.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    seen = candidates.join(hidden, ["lang", "phrase"], "left")
    seen = seen.where(f"longer IS NULL OR 100 * longer < {hiding} * a").drop("longer")
    cuts = seen.select("*", F.explode(F.expr("sequence(1, words - 1)")).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", text(F.lit(1), F.col("cut")).alias("left"), text(F.col("cut") + 1, F.col("words")).alias("right"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang")
    score = F.expr("(CAST(1000 AS DECIMAL(38, 0)) * a * n) div (CAST(l AS DECIMAL(38, 0)) * r)")
    least = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("least"))
    return least.select("lang", "phrase", "a", "least.l", "least.r", "n", "least.score")


def ranked(rows: DataFrame, top: int = TOP) -> DataFrame:
    """The first `top` rows of each language; a language's rows meet in parts first, the best of the parts after that."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    in_part = Window.partitionBy("lang", "part").orderBy(*order)
    best = dealt.withColumn("place", F.row_number().over(in_part)).where(F.col("place") <= top).drop("place", "part")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return best.withColumn("rank", place).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(documents: DataFrame, support: int = SUPPORT, longest: int = WORDS, shards: int = SHARDS, top: int = TOP, hiding: int = HIDING) -> DataFrame:
    """The best-scored phrases of each language."""
    counts, totals = phrase_counts(documents, support, longest, shards)
    return ranked(scored(counts, totals, hiding), top)
