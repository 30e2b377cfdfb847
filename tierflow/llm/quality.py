"""Quality rules as a short-circuit cascade.

A rule looks at one text and rejects it or lets it pass. A bounded sample gives each rule's cost (seconds a text) and
selectivity (share of texts rejected). The cascade runs the rules by falling rejection per cost and stops at the first
rejection. The order changes the time only: a text is rejected if any rule rejects it.

Defined results: a null text is the empty text; it has no words, all counts are 0 and the fixed limits fail it. Every
input row gives one output row, repeated rows and null ids included. Ties in rejection per cost keep the rules' order as
written. An empty table gives an empty result, and the rules then run in the order written. Other columns of the input
are ignored, whatever their names.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import BLANKS, slices, texts, whole_text

SYMBOLS = "#*$%&|<>"
WINDOW = 8
SAMPLE_ROWS = 300

_BLANK_BYTES = BLANKS.encode()
_MIXERS = np.random.default_rng(8).integers(1, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Text:
    """One text with the measures that rules share, each computed when first asked for."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        # bytes.split() cuts at exactly the six ASCII blanks.
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(self.text.count(blank) for blank in BLANKS)

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.text.count(symbol) for symbol in SYMBOLS)

    @cached_property
    def lines(self) -> list[str]:
        """The lines that have a word."""
        return [line for line in self.text.split("\n") if line.strip(BLANKS)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of `size` words found twice or more, the first occurrence included."""
    places = len(words) - size + 1
    if places < 2:
        return 0
    codes: dict[bytes, int] = {}
    numbers = np.fromiter((codes.setdefault(word, len(codes)) for word in words), np.uint64, len(words))
    keys = np.zeros(places, np.uint64)
    for i in range(size):
        keys = (keys ^ (keys >> np.uint64(29))) * _MIXERS[i % WINDOW] + numbers[i : i + places]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    marked = np.zeros(places, bool)
    marked[order[1:][same]] = True
    marked[order[:-1][same]] = True
    candidates = np.flatnonzero(marked)
    found = Counter(numbers[p : p + size].tobytes() for p in candidates)  # the windows themselves, not their keys
    covered = np.zeros(len(words), bool)
    for p in candidates:
        if found[numbers[p : p + size].tobytes()] > 1:
            covered[p : p + size] = True
    return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    """`rejects` says whether a text goes."""

    name: str
    rejects: Callable[[Text], bool]


def _per_word(measure: Callable[[Text], float], low: float, high: float) -> Callable[[Text], bool]:
    return lambda text: bool(text.words) and not low <= measure(text) / len(text.words) <= high


def _letterless(text: Text) -> int:
    return sum(not any(map(str.isalpha, word.decode("utf-8", "replace"))) for word in text.words)


def _bullets(text: Text) -> bool:
    marks = ("-", "*", "•", "●", "‣")
    return len(text.lines) > 3 and sum(x.lstrip(BLANKS).startswith(marks) for x in text.lines) > 0.9 * len(text.lines)


def _ellipses(text: Text) -> bool:
    return len(text.lines) > 3 and sum(x.rstrip(BLANKS).endswith(("...", "…")) for x in text.lines) > 0.3 * len(text.lines)


#: The limits are wide: ordinary prose in any of the languages stays well inside them.
RULES = (
    Rule("symbols", _per_word(lambda text: text.n_symbols, 0, 0.1)),
    Rule("repeated_lines", lambda text: len(text.lines) > 3 and text.n_dup_lines > 0.4 * len(text.lines)),
    Rule("word_length", _per_word(lambda text: text.word_chars, 2, 15)),
    Rule("vocabulary", lambda text: len(text.words) > 100 and len(set(text.words)) < 0.1 * len(text.words)),
    Rule("letterless_words", _per_word(_letterless, 0, 0.4)),
    Rule("bullets", _bullets),
    Rule("ellipses", _ellipses),
)


def cascade(rules: tuple[Rule, ...], sample: list[str], clock: Callable[[], float] = time.perf_counter) -> list[Rule]:
    """The rules by falling rejection per cost, as measured on the sample; each rule meets fresh texts."""

    def rejection_per_cost(rule: Rule) -> float:
        start, rejected = clock(), 0
        for text in sample:
            rejected += rule.rejects(Text(text))
        return rejected / max(clock() - start, 1e-9)

    return sorted(rules, key=rejection_per_cost, reverse=True)


def passes(text: Text, ordered: list[Rule]) -> bool:
    return not any(rule.rejects(text) for rule in ordered)


def sample_texts(documents: DataFrame, rows: int = SAMPLE_ROWS) -> list[str]:
    """At most `rows` texts, chosen by a hash of the id; the driver holds these few only."""
    count = documents.count()
    share = min(1.0, 4 * rows / max(count, 1))
    picked = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    return [row[0] for row in picked.select(whole_text()).limit(rows).collect()]


COLUMNS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"


def judge(documents: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row the base measures, whether the fixed limits fail it, and the verdict of limits and cascade."""
    ordered = cascade(rules, sample_texts(documents, sample_rows))
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(name, pa.int64()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for value in texts(part, "text"):
                    text = Text(value)
                    n = len(text.words)
                    failed = n < 20 or 100 * text.n_repeat_words > 30 * n
                    measures = (n, text.word_chars, text.n_symbols, text.n_dup_lines, text.n_repeat_words)
                    rows.append((*measures, failed, not failed and passes(text, ordered)))
                columns = [part.column("doc_id"), *map(list, zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(measure, COLUMNS)


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents, all columns, whose text the limits and the cascade keep."""
    ordered = cascade(RULES, sample_texts(documents))
    schema = documents.schema

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                keep = []
                for value in texts(part, "text"):
                    text = Text(value)
                    n = len(text.words)
                    keep.append(n >= 20 and passes(text, ordered) and 100 * text.n_repeat_words <= 30 * n)
                yield part.filter(pa.array(keep))

    return documents.mapInArrow(kept, schema)
