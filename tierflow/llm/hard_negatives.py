"""Hard negatives for anchors: near rows of other labels, mined with a secondary sort.

1. Every anchor meets every row once, in blocks: rows and anchors are dealt into parts of bounded size by their id, and a
   task holds one part of each, whose scores are one matrix product.
2. The best same-label rows of a part go on as (anchor, descending score, id); sorted by that key inside the partitions of
   a shuffle by anchor, the first few of an anchor are its positives.
3. A positive opens a window of scores. With the windows known, each part sends the best different-label rows of every
   window, packed into the same kind of key, and the positives themselves. Spark's shuffle sorts them (repartition with
   sortWithinPartitions, the DataFrame's form of repartitionAndSortWithinPartitions, which spills to disk); an iterator
   reads the keys in order, opens a window at each positive, and emits negatives until the window is full. It holds the
   open windows of one anchor and nothing else, however many rows the anchor has.

What parts leave out is below the best rows of the same part and could not be returned, so results are exact.

Defined results: rows without an id, a label or a vector, or with a null or non-finite component take no part. Of rows that
repeat an id the one with the least (label, vector) counts. Vectors of different lengths are compared as if the shorter one
ended in zeros; an empty one scores 0. Scores beyond 64 bits are cut to the largest long. Ties go to the smaller id. An
anchor without positives, or a positive whose window is empty, gives no rows; an empty table gives none. Further columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import frozen

POSITIVES = 5
NEGATIVES = 3
# A window reaches from LOW to HIGH per cent of the positive's score.
LOW, HIGH = 50, 95
# Rows and anchors that one task holds, about.
PART_ROWS, PART_ANCHORS = 4096, 1024

_LONG = np.iinfo(np.int64)
_SCORED = "anchor_id long, descending long, kind int, id long"


def usable_vectors(rows: DataFrame, label: Column, scale: int = 256, vector: str = "embedding", row_id: str = "vec_id") -> DataFrame:
    """(id, label, vector): each component times `scale`, rounded down; one row per id."""
    whole = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taken = rows.select(F.col(row_id).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("vector"), finite.alias("fit"))
    floored = F.transform("vector", lambda x: F.floor(x * float(scale)))
    fit = taken.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND fit").select("id", "label", floored.alias("vector"))
    return fit.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")


def _matrix(vectors: list) -> np.ndarray:
    """One row per vector, zeros behind the shorter ones."""
    sizes = np.array([len(v) for v in vectors], np.int64)
    matrix = np.zeros((len(vectors), int(sizes.max(initial=0))), np.int64)
    if len(vectors):
        matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = np.concatenate([np.asarray(v, np.int64) for v in vectors])
    return matrix


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of `a` and `b`."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    largest = int(max(a.max(initial=0), -int(a.min(initial=0)))) * int(max(b.max(initial=0), -int(b.min(initial=0)))) * max(width, 1)
    if largest < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if largest < 1 << 63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -_LONG.max, _LONG.max).astype(np.int64)


def _window(positive: int) -> tuple[int, int]:
    """Smallest and largest score inside the window of a positive; empty below zero."""
    return -(-LOW * positive // 100), HIGH * positive // 100


def _by_label(anchors: pd.DataFrame, rows: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """The anchors of one label at a time, and which rows share it."""
    for label, mine in anchors.groupby("label", sort=False):
        yield mine, (rows["label"] == label).to_numpy()


def _frame(anchors: list, scores: list, ids: list, kind: int) -> pd.DataFrame:
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (anchors, scores, ids)]
    return pd.DataFrame({"anchor_id": joined[0], "descending": -joined[1], "kind": np.full(len(joined[0]), kind, np.int32), "id": joined[2]})


def _best_positives(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The part's best same-label rows of each anchor."""
    rows = rows.sort_values("id")
    found = [], [], []
    for mine, same in _by_label(anchors, rows):
        ids = rows["id"].to_numpy()[same]
        if not len(ids):
            continue
        scores = _scores(_matrix(mine["vector"].tolist()), _matrix(rows["vector"][same].tolist()))
        # One more than needed, as the anchor itself may be among them.
        best = np.argsort(-scores, axis=1, kind="stable")[:, : POSITIVES + 1]
        of = np.repeat(mine["id"].to_numpy(), best.shape[1])
        chosen = ids[best.ravel()]
        other = chosen != of
        found[0].append(of[other])
        found[1].append(np.take_along_axis(scores, best, 1).ravel()[other])
        found[2].append(chosen[other])
    return _frame(*found, 0)


def _best_negatives(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """The part's best different-label rows in each window of each anchor."""
    rows = rows.sort_values("id")
    found = [], [], []
    for mine, same in _by_label(anchors, rows):
        ids = rows["id"].to_numpy()[~same]
        if not len(ids):
            continue
        scores = _scores(_matrix(mine["vector"].tolist()), _matrix(rows["vector"][~same].tolist()))
        wanted = np.zeros(scores.shape, bool)
        places = np.arange(len(mine))
        for k in range(POSITIVES):
            bounds = [_window(int(w[k])) if k < len(w) else (1, 0) for w in mine["windows"]]
            low, high = (np.array(x, np.int64)[:, None] for x in zip(*bounds, strict=True))
            left = np.where((scores >= low) & (scores <= high), scores, _LONG.min)
            for _ in range(NEGATIVES):
                top = left.argmax(axis=1)  # the first of equal scores has the smallest id
                inside = left[places, top] > _LONG.min
                wanted[places[inside], top[inside]] = True
                left[places, top] = _LONG.min
        at, column = np.nonzero(wanted)
        found[0].append(mine["id"].to_numpy()[at])
        found[1].append(scores[at, column])
        found[2].append(ids[column])
    return _frame(*found, 1)


def _against_all(anchors: DataFrame, rows: DataFrame, anchor_parts: int, row_parts: int, best) -> DataFrame:
    """`best` of every part of the anchors beside every part of the rows."""

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias(own)
        renewed = [F.col(name).alias(name) for name in df.columns]  # anchors and rows come from one table
        return df.select(*renewed, mine, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    a = dealt(anchors, "a_part", anchor_parts, "r_part", row_parts).groupBy("a_part", "r_part")
    r = dealt(rows, "r_part", row_parts, "a_part", anchor_parts).groupBy("a_part", "r_part")
    return a.cogroup(r).applyInPandas(best, _SCORED)


def _in_order(scored: DataFrame, read, schema: str) -> DataFrame:
    """The keys of each anchor in descending order of score, positives before negatives, through one iterator."""
    keys = ["anchor_id", "descending", "kind", "id"]
    return scored.repartition("anchor_id").sortWithinPartitions(*keys).mapInArrow(read, schema)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Iterator[tuple]]]:
    for batch in batches:
        yield batch, zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True)


def _take_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first few keys of each anchor."""
    anchor, seen = None, 0
    for batch, keys in _keys(batches):
        kept = []
        for key in keys:
            if key[0] != anchor:
                anchor, seen = key[0], 0
            seen += 1
            kept.append(seen <= POSITIVES)
        yield batch.filter(pa.array(kept, pa.bool_()))


_MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _fill_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows open at positives; negatives go to every open window that reaches them and is not full."""
    names = [part.split()[0] for part in _MINED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    anchor, windows = None, []
    for _, keys in _keys(batches):
        out = []
        for of, descending, kind, row in keys:
            score = -descending
            if of != anchor:
                anchor, windows = of, []
            if kind == 0:
                windows.append([row, score, *_window(score), 0])
                continue
            for window in windows:
                positive, positive_score, low, high, filled = window
                if low <= score <= high and filled < NEGATIVES:
                    window[4] = filled + 1
                    out.append((of, positive, filled + 1, row, positive_score, score))
            # Scores only fall from here on: full windows, and those left behind, are closed.
            windows = [w for w in windows if w[4] < NEGATIVES and score >= w[2]]
        columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def mine(vectors: DataFrame, anchors: Column) -> DataFrame:
    """The hard negatives of the rows of `vectors` (id, label, vector) for which `anchors` holds.

    One row per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    rows = frozen(vectors, "vectors")
    chosen = rows.where(anchors)
    n_rows, n_anchors = rows.count(), chosen.count()
    parts = max(1, -(-n_anchors // PART_ANCHORS)), max(1, -(-n_rows // PART_ROWS))
    positives = frozen(_in_order(_against_all(chosen, rows, *parts, _best_positives), _take_positives, _SCORED), "positives")
    # POSITIVES scores per anchor at most.
    windows = positives.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(-F.col("descending")).alias("windows"))
    negatives = _against_all(chosen.join(windows, "id"), rows, *parts, _best_negatives)
    return _in_order(positives.unionAll(negatives), _fill_windows, _MINED)
