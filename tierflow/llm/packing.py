"""Best-two-fit packing of tokenised documents into sequences.

Only lengths matter to the packing, and there are at most as many lengths as a sequence has tokens. So the plan is made
on the histogram of lengths (bounded by the capacity, whatever the number of documents): fill a sequence greedily with the
largest pieces that still fit; then take out its smallest piece if two unpacked pieces together fill the widened gap more
tightly, and again while that helps. A composition found once is repeated as often as the counts allow, which gives the
same sequences as going one by one. The plan says which positions within each length go into which sequence; Spark numbers
the pieces of each length (hash buckets of bounded size, then offsets of buckets) and joins them to the plan.

Defined results: a null text is the empty text; its document is the end token alone. Every row is a document of its own,
repeated rows and null ids included. Equal lengths are interchangeable; which of them lands where follows a hash of the row.
An empty table gives an empty result. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow.llm.common import frozen, slices, texts

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k.tiktoken"
# The file that names the special strings of the same vocabulary.
SPECIALS = "byte_bpe_50k.json"
# A worker keeps the ids of this many distinct words.
CACHED_WORDS = 700_000
ROWS_A_BUCKET = 20_000

# Runs of non-blanks with the blank before them, and runs of blanks: the pre-tokeniser never joins across these.
# The white space of Unicode, by code point.
_BLANK_POINTS = (*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
_SPACE = "".join(map(chr, _BLANK_POINTS))
_CHUNKS = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


class WordIds(dict):
    """The ids of a run of text as little-endian bytes, by run; bounded.

    Special strings are one id each wherever they stand, as `tokenizers` has them; what lies between them is text of its own.
    """

    def __init__(self, path: str, specials: dict[str, int] | None = None):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.specials = {text: np.array([number], "<u4").tobytes() for text, number in (specials or {}).items()}
        longest_first = sorted(self.specials, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split if self.specials else None

    def __missing__(self, run: str) -> bytes:
        ids = np.array(self.encoding.encode_ordinary(run), "<u4").tobytes()
        if len(run) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[run] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not any(special in text for special in self.specials):
            return b"".join(map(self.__getitem__, _CHUNKS.findall(text)))
        parts = self.split(text)
        return b"".join(self.specials[part] if k % 2 else b"".join(map(self.__getitem__, _CHUNKS.findall(part))) for k, part in enumerate(parts))


def special_strings(path: str) -> dict[str, int]:
    """The special strings of a tokenizer file with their ids."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    odd = [token for token in added if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]]
    if odd:
        raise ValueError(f"{path}: these added tokens are more than plain strings: {odd}")
    return {token["content"]: token["id"] for token in added}


@lru_cache(maxsize=1)
def word_ids(path: str, specials: str | None = None) -> WordIds:
    return WordIds(path, special_strings(specials or specials_path()))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def specials_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(SPECIALS)


def cuts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, and the rest first."""
    first = length % capacity or capacity
    if length <= capacity:
        return [(0, length)]
    return [(0, first), *((start, capacity) for start in range(first, length, capacity))]


def tokenised(documents: DataFrame, capacity: int = CAPACITY, path: str | None = None, specials: str | None = None) -> DataFrame:
    """The pieces of every document: row, doc_id, piece, start, length and ids_crc32."""
    path, specials = path or vocabulary_path(), specials or specials_path()
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32())]
        + [(name, pa.int64()) for name in ("start", "length", "ids_crc32")]
    )
    end = np.array([END], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path, specials)
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for row, doc_id, text in zip(part.column("row").to_pylist(), part.column("doc_id").to_pylist(), texts(part, "text"), strict=True):
                    ids = words.encode(text) + end
                    for piece, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                        out.append((row, doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                arrays = [pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    narrow = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    return narrow.mapInArrow(pieces, "row long, doc_id long, piece int, start long, length long, ids_crc32 long")


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Compositions of sequences (lengths in order) and how often each is used, from the count of each length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    plan = []
    while left.any():
        free, peak, bin_ = left.copy(), np.zeros_like(left), []

        def put(length: int, free=free, peak=peak, bin_=bin_) -> None:
            free[length] -= 1
            bin_.append(length)
            peak[length] = max(peak[length], left[length] - free[length])

        put(int(np.flatnonzero(free)[-1]))
        gap = capacity - bin_[0]
        while gap and (fitting := np.flatnonzero(free[: gap + 1])).size:
            put(int(fitting[-1]))
            gap -= bin_[-1]
        while gap and len(bin_) > 1:
            smallest = min(bin_)
            pair = tightest_pair(free, smallest + gap)
            if not pair or sum(pair) <= smallest:
                break
            bin_.remove(smallest)
            free[smallest] += 1
            put(pair[0])
            put(pair[1])
            gap += smallest - sum(pair)
        used = np.bincount(bin_, minlength=capacity + 1)
        need = np.flatnonzero(used)
        copies = int(((left[need] - peak[need]) // used[need]).min()) + 1
        left -= copies * used
        plan.append((sorted(bin_, reverse=True), copies))
    return plan


def tightest_pair(free: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two free lengths with the largest sum up to `room`, the longer one as long as possible."""
    lengths = np.flatnonzero(free[: room + 1])
    if not lengths.size:
        return None
    # For each first length the largest second one that fits and is not longer than it.
    limit = np.minimum(room - lengths, lengths)
    second = np.searchsorted(lengths, limit, side="right") - 1
    same = (second >= 0) & (lengths[np.maximum(second, 0)] == lengths) & (free[lengths] < 2)
    second = np.where(same, second - 1, second)
    sums = np.where(second >= 0, lengths + lengths[np.maximum(second, 0)], -1)
    best = int(np.flatnonzero(sums == sums.max())[-1])
    return (int(lengths[best]), int(lengths[second[best]])) if sums[best] > 0 else None


def segments(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first position, positions, first sequence, offset): positions of a length that go to sequences in a row."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, copies in plan:
        offset = 0
        for length in lengths:
            first = taken.get(length, 0)
            rows.append((length, first, copies, sequence, offset))
            taken[length] = first + copies
            offset += length
        sequence += copies
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces that have `row`, `piece` and `length`; `pieces` must be a written table."""
    spark = pieces.sparkSession
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}  # `capacity` rows at most
    rows = segments(best_two_fit(counts, capacity))
    # A few segments per length: bounded by the capacity, not by the number of documents.
    plan = spark.createDataFrame(rows, "length long, first_position long, positions long, first_sequence long, offset long")
    buckets = max(64, sum(counts.values()) // ROWS_A_BUCKET)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("held"))
    starts = starts.select("length", "bucket", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("length", "bucket").orderBy("row", "piece")
    placed = (
        dealt.withColumn("inside", F.row_number().over(inside) - 1)
        .join(starts, ["length", "bucket"])
        .withColumn("position", F.col("earlier") + F.col("inside"))
        .join(F.broadcast(plan), "length")
        .where("position >= first_position AND position < first_position + positions")
    )
    sequence = F.col("first_sequence") + F.col("position") - F.col("first_position")
    return placed.select(*pieces.columns, sequence.alias("sequence_id"), "offset")


def packed_documents(documents: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack: one row per piece."""
    pieces = frozen(tokenised(documents, capacity), "pieces")
    return pack(pieces, capacity).drop("row")
