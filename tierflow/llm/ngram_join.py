"""Similarity join of documents on word n-grams (Jaccard) with prefix trees.

1. Each text becomes the set of its distinct shingles, as 64-bit hashes. Tasks send (shingle, document) pairs, packed per
   range of hashes, to buckets; no text moves. A bucket knows how many documents hold each of its shingles, which gives the
   global order: rarest first.
2. Two sets that are similar enough share a shingle within the first |x| - ceil(t |x|) + 1 of that order (prefix filter),
   and their sizes differ by a factor of t at most. For each shingle the documents of fitting sizes are tied to one of them;
   only the ties go back to the documents, which keep those inside their own prefix (equal frequencies at its end stay
   whole, so no tie is lost). Connected ties form blocks: links never leave a block.
3. Equal sets of a block are one class. Blocks are cut into cells of CELL_SETS classes at most; larger blocks take every
   pair of their parts, so every pair of classes meets in a cell and no task holds an unbounded block. A cell stores its
   sets in a prefix tree, in one order for all: runs shared by several sets are walked once, and a subtree is left as soon
   as the sizes that remain cannot reach the required overlap. Sets that are already connected need no further search, so
   a large group of near copies does not cost all its pairs.
4. Links found are joined to components.

Defined results: null and empty texts, and texts of blanks only, have the empty set and link with nothing. A text with
fewer than n words is one shingle of all its words. Every input row gives one output row; repeated rows are equal sets and
so linked. The component is the smallest doc_id reached; null ids never win against others, and a row linked with nothing
has its own id, null included. An empty table gives an empty result. Other columns are ignored in the join and kept by
`keep_one`, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow.llm.common import free_name, frozen, slices, texts, whole_text
from tierflow.llm.components import components

WORDS = 5
PERCENT = 75
CELL_SETS = 1000
# Text bytes whose shingles go to one bucket; a bucket is held by one task.
BUCKET_BYTES = 9_000_000
CACHED_WORDS = 400_000
# Documents of a slice, and from how many of them a shingle is sent by stand-ins.
SLICE_ROWS = 1 << 15
STOOD_FOR = 24
# Bits of the map that tells which documents the cells need: 4 MB whatever the number of documents.
MAP_BITS = 1 << 25

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """64-bit hash by word; bounded."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


_HASHES = WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingle_sets(values: list[str], size: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, A-Z lower-cased."""
    words = [value.encode("utf-8", "surrogatepass").lower().split() for value in values]
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    hashes = np.fromiter((h for w in words for h in map(_HASHES.__getitem__, w)), np.uint64, int(ends[-1]) if len(ends) else 0)
    shingles = np.full(max(len(hashes) - size + 1, 0), size, np.uint64)
    for i in range(size):
        shingles = _mixed(shingles * _ODD + hashes[i : i + len(shingles)])
    sets, start = [], 0
    for end in ends.tolist():
        if end - start >= size:
            sets.append(np.unique(shingles[start : end - size + 1]))
        elif end > start:
            whole = np.array([end - start], np.uint64)
            for h in hashes[start:end]:
                whole = _mixed(whole * _ODD + h)
            sets.append(whole)
        else:
            sets.append(np.zeros(0, np.uint64))
        start = end
    return sets


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def prefix_length(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


# ---- 1. shingles to buckets -------------------------------------------------------------------------------------------

_PACKED = "bucket long, chunk long, tokens binary, places binary, sizes binary, stood binary, meta binary"
_BLOBS = ("tokens", "places", "sizes", "stood", "meta")
# A stand-in: its place beyond the slice's documents, the first document it stands for, that one's size, and how many.
_STOOD = np.dtype([("token", "<u8"), ("place", "<u4"), ("first", "<u4"), ("size", "<u4"), ("weight", "<u4")])
_NODE = np.dtype([("doc_id", "<i8"), ("known", "?"), ("text_key", "<i8"), ("n", "<i8"), ("digest", "V16")])


def _packed(buckets: int):
    """Per slice of documents and bucket one row: shingles (differences, byte by byte), places in the slice, set sizes, stand-ins.

    A shingle that many documents of a slice hold is summed up before it leaves: a few stand-ins of fitting sizes go to
    the bucket with the number of documents they stand for, so what a bucket gets of a very frequent shingle grows with
    the slices, not with the documents.
    """
    schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), *((x, pa.binary()) for x in _BLOBS)])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        for batch in batches:
            for part in slices(batch, "text"):
                for at in range(0, part.num_rows, SLICE_ROWS):
                    piece = part.slice(at, SLICE_ROWS)
                    yield _packed_slice(piece, chunk, buckets, schema)
                    chunk += 1

    return pack


def _packed_slice(part: pa.RecordBatch, chunk: int, buckets: int, schema: pa.Schema) -> pa.RecordBatch:
    sets = shingle_sets(texts(part, "text"))
    sizes = np.array([len(s) for s in sets], np.int64)
    nodes = np.zeros(len(sets), _NODE)
    ids = part.column("doc_id")
    nodes["doc_id"], nodes["known"] = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False)
    nodes["text_key"], nodes["n"] = part.column("text_key").to_numpy(zero_copy_only=False), sizes
    nodes["digest"] = np.frombuffer(b"".join(map(_digest, sets)), "V16")
    tokens = np.concatenate(sets) >> np.uint64(16)  # 48 bits: an equal pair can only add a candidate
    places = np.repeat(np.arange(len(sets), dtype="<u4"), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, places, stood, members = _stand_ins(tokens[order], places[order], sizes)
    edges = (np.arange(1, buckets, dtype=np.float64) * (2.0**48 / buckets)).astype(np.uint64)
    bounds = [0, *np.searchsorted(tokens, edges).tolist(), len(tokens)]
    stood_bounds = [0, *np.searchsorted(stood["token"], edges).tolist(), len(stood)]
    home = chunk % buckets
    rows = []
    for bucket in range(buckets):
        first, last = bounds[bucket], bounds[bucket + 1]
        own_stood = stood[stood_bounds[bucket] : stood_bounds[bucket + 1]]
        if last > first or len(own_stood) or bucket == home:
            steps = np.diff(tokens[first:last], prepend=np.uint64(0)).astype("<u8")
            planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes()
            held = (places[first:last].astype("<u4"), sizes[places[first:last]].astype("<u4"))
            by_byte = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes() for x in held]
            meta = pickle.dumps((nodes, stood["weight"][np.argsort(stood["place"])], members)) if bucket == home else None
            rows.append((bucket, chunk, planes, *by_byte, own_stood.tobytes(), meta))
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _stand_ins(tokens: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pairs without those of frequent shingles, the stand-ins for these by shingle, and whom they stand for by place.

    The documents of a shingle are put in order of size. Those chosen are the smallest and the largest one, and between
    them as few as keep neighbours within the factor of sizes wherever the documents themselves are. A stand-in stands
    for itself and for the documents up to the next one; its place is a number beyond the documents of the slice.
    """
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    at = np.append(np.flatnonzero(new), len(tokens))
    often = np.flatnonzero(np.diff(at) >= STOOD_FOR)
    keep = np.ones(len(tokens), bool)
    added: list[tuple[int, int, int, int, int]] = []
    members: list[np.ndarray] = []
    for group in often.tolist():
        low, high = int(at[group]), int(at[group + 1])
        keep[low:high] = False
        own = places[low:high].astype(np.int64)
        own = own[np.argsort(sizes[own], kind="stable")]
        size = sizes[own]
        chosen = [0]
        while chosen[-1] < len(own) - 1:
            # The last one still within the factor of the one chosen before, or the next one where the factor breaks.
            reach = int(np.searchsorted(size, size[chosen[-1]] * 100 // PERCENT, side="right")) - 1
            chosen.append(max(reach, chosen[-1] + 1))
        for a, b in zip(chosen, [*chosen[1:], len(own)], strict=True):
            added.append((int(tokens[low]), len(sizes) + len(added), int(own[a]), int(size[a]), b - a))
            members.append(own[a:b].astype("<u4"))
    together = np.concatenate(members) if members else np.zeros(0, "<u4")
    return tokens[keep], places[keep], np.array(added, _STOOD), together


def _by_byte(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _unpacked(planes: bytes) -> np.ndarray:
    raw = np.frombuffer(planes, np.uint8).reshape(6, -1)
    steps = np.zeros((raw.shape[1], 8), np.uint8)
    steps[:, :6] = raw.T
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


# ---- 2. ties inside a bucket ------------------------------------------------------------------------------------------

_TIE = np.dtype([("place", "<u4"), ("rarity", "u1"), ("hub", "<i8"), ("count", "<u4")])
# A document's number: its slice, then its place there.
_PLACE_BITS = 15
_TIED = "chunk long, ties binary, meta binary"


def _rarity(frequency: np.ndarray) -> np.ndarray:
    """A coarse, growing scale of frequencies: 0 for one document, then eight steps per doubling."""
    return np.minimum(np.ceil(8 * np.log2(frequency)), 255).astype(np.uint8)


def _tie(pdf: pd.DataFrame) -> pd.DataFrame:
    stood = [np.frombuffer(s, _STOOD) for s in pdf.stood]
    held = [_by_byte(p) for p in pdf.places]
    rows = np.repeat(np.arange(len(held)), [len(p) for p in held])
    stood_rows = np.repeat(np.arange(len(stood)), [len(s) for s in stood])
    stood = np.concatenate(stood)
    # Documents first, then stand-ins, which are tied as the first document they stand for.
    tokens = np.concatenate([*(_unpacked(planes) for planes in pdf.tokens), stood["token"]])
    sizes = np.concatenate([*(_by_byte(s) for s in pdf.sizes), stood["size"]])
    places = np.concatenate([*held, stood["place"]]).astype(np.int64)
    names = np.concatenate([*held, stood["first"]]).astype(np.int64)
    weights = np.ones(len(tokens), np.int64)
    weights[len(rows) :] = stood["weight"]
    rows = np.concatenate([rows, stood_rows])
    owners = (pdf.chunk.to_numpy(np.int64)[rows] << _PLACE_BITS) + names
    order = np.argsort(tokens, kind="stable")
    tokens = tokens[order]
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    entries = np.diff(np.append(np.flatnonzero(new), len(tokens)))
    frequency = np.add.reduceat(weights[order], np.flatnonzero(new)) if len(tokens) else entries
    shared = np.repeat(frequency > 1, entries)
    rarity = np.repeat(_rarity(frequency), entries)[shared]
    group = np.repeat(np.arange(len(entries)), entries)[shared]
    places, rows, owners, weights = places[order][shared], rows[order][shared], owners[order][shared], weights[order][shared]
    sizes = sizes[order][shared].astype(np.int64)
    order = np.lexsort((owners, sizes, group))
    rarity, group, sizes = rarity[order], group[order], sizes[order]
    places, rows, owners, weights = places[order], rows[order], owners[order], weights[order]
    # Within a shingle, sizes that lie too far apart cannot be linked: a run ends there.
    starts = np.ones(len(rows), bool)
    starts[1:] = (group[1:] != group[:-1]) | (100 * sizes[:-1] < PERCENT * sizes[1:])
    at = np.flatnonzero(starts)
    length = np.diff(np.append(at, len(rows)))
    held = np.add.reduceat(weights, at) if len(at) else length
    hub = np.where(np.repeat(held, length) > 1, np.repeat(owners[at], length) if len(at) else owners, -1)
    # Equal (document, rarity, hub) become one row with a count.
    order = np.lexsort((hub, rarity, places, rows))
    places, rows, rarity, hub = places[order], rows[order], rarity[order], hub[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (places[1:] != places[:-1]) | (rarity[1:] != rarity[:-1]) | (hub[1:] != hub[:-1])
    at = np.flatnonzero(first)
    ties = np.zeros(len(at), _TIE)
    ties["place"], ties["rarity"], ties["hub"] = places[at], rarity[at], hub[at]
    ties["count"] = np.diff(np.append(at, len(rows)))
    bounds = np.searchsorted(rows[at], np.arange(len(pdf) + 1))
    out = [
        (chunk, ties[bounds[k] : bounds[k + 1]].tobytes(), meta)
        for k, (chunk, meta) in enumerate(zip(pdf.chunk, pdf.meta, strict=True))
        if bounds[k + 1] > bounds[k] or meta is not None
    ]
    return pd.DataFrame(out, columns=["chunk", "ties", "meta"])


_NODES = "node long, doc_id long, text_key long, n_shingles long, digest binary, hubs array<long>"


def _spread(ties: np.ndarray, documents_: int, all_counts: np.ndarray, members: np.ndarray) -> np.ndarray:
    """The ties with those of stand-ins given to every document they stand for."""
    stood = ties["place"] >= documents_
    which = ties["place"][stood].astype(np.int64) - documents_
    counts = all_counts[which]
    spread = np.repeat(ties[stood], counts)
    begins = (np.cumsum(all_counts) - all_counts)[which]
    within = np.arange(len(spread)) - np.repeat(np.cumsum(counts) - counts, counts)
    spread["place"] = members[np.repeat(begins, counts) + within]
    return np.concatenate([ties[~stood], spread])


def _own_prefix(pdf: pd.DataFrame) -> pd.DataFrame:
    """The documents of a slice, each with the ties inside its prefix."""
    nodes, counts, members = pickle.loads(next(m for m in pdf.meta if m is not None))
    ties = _spread(np.concatenate([np.frombuffer(t, _TIE) for t in pdf.ties]), len(nodes), counts.astype(np.int64), members)
    ties = ties[np.lexsort((ties["rarity"], ties["place"]))]
    place, rarity, count = ties["place"].astype(np.int64), ties["rarity"].astype(np.int64), ties["count"].astype(np.int64)
    n = nodes["n"]
    alone = n - np.bincount(place, count, len(n)).astype(np.int64)
    # Shingles rarer than a tie's own: those of this document alone, and those of smaller rarity.
    before = np.cumsum(count) - count
    new = np.diff(place * 256 + rarity, prepend=-1) != 0
    group_start = before[np.maximum.accumulate(np.where(new, np.arange(len(ties)), 0))] if len(ties) else before
    new_place = np.diff(place, prepend=-1) != 0
    place_start = before[np.maximum.accumulate(np.where(new_place, np.arange(len(ties)), 0))] if len(ties) else before
    rarer = alone[place] + group_start - place_start
    own = (int(pdf.chunk.iloc[0]) << _PLACE_BITS) + place
    inside = (rarer < prefix_length(n)[place]) & (ties["hub"] >= 0) & (ties["hub"] != own)
    pairs = np.unique(np.stack([place[inside], ties["hub"][inside]]), axis=1) if inside.any() else np.zeros((2, 0), np.int64)
    hubs = np.split(pairs[1], np.searchsorted(pairs[0], np.arange(1, len(n)))) if len(n) else []
    return pd.DataFrame(
        {
            "node": (int(pdf.chunk.iloc[0]) << _PLACE_BITS) + np.arange(len(n)),
            "doc_id": pd.arrays.IntegerArray(nodes["doc_id"].copy(), ~nodes["known"]),
            "text_key": nodes["text_key"].copy(),
            "n_shingles": n.copy(),
            "digest": [d.tobytes() for d in nodes["digest"]],
            "hubs": list(hubs),
        }
    )


def candidate_nodes(documents: DataFrame) -> DataFrame:
    """Per row a node number, doc_id, a hash of the text, the size and digest of its set, and its ties; a written table."""
    narrow = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), F.xxhash64(whole_text()).alias("text_key")
    )
    held = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, held // BUCKET_BYTES)
    packed = narrow.mapInArrow(_packed(buckets), _PACKED)
    tied = packed.groupBy("bucket").applyInPandas(_tie, _TIED)
    return frozen(tied.groupBy("chunk").applyInPandas(_own_prefix, _NODES), "shingle-nodes")


# ---- 3. prefix trees inside cells -------------------------------------------------------------------------------------


class PrefixTree:
    """Ordered sets as paths; a run of elements without a branch is one edge. Sets must be distinct."""

    def __init__(self, ranked: list[np.ndarray]):
        self.sets = ranked
        order = sorted(range(len(ranked)), key=lambda k: ranked[k].astype(">u4").tobytes())
        # A node is [elements of its edge, depth of its end, children, set that ends here, smallest and largest size below].
        self.root = [np.zeros(0, np.int64), 0, [], None, 0, 0]
        path, last = [self.root], None
        for k in order:
            own = ranked[k]
            common = 0
            if last is not None:
                limit = min(len(last), len(own))
                differ = np.flatnonzero(last[:limit] != own[:limit])
                common = int(differ[0]) if differ.size else limit
            child = None
            while path[-1][1] > common:
                child = path.pop()
            top = path[-1]
            if top[1] < common:  # the branch lies inside an edge: split it
                middle = [child[0][: common - top[1]], common, [child], None, 0, 0]
                child[0] = child[0][common - top[1] :]
                top[2][-1] = middle
                path.append(middle)
                top = middle
            leaf = [own[common:], len(own), [], k, 0, 0]
            top[2].append(leaf)
            path.append(leaf)
            last = own
        self._sizes()

    def _sizes(self) -> None:
        walk, order = [self.root], []
        while walk:
            node = walk.pop()
            order.append(node)
            walk += node[2]
        for node in reversed(order):
            below = [x for child in node[2] for x in child[4:6]] + ([node[1]] if node[3] is not None else [])
            node[4], node[5] = (min(below), max(below)) if below else (0, 0)

    def similar(self, query: np.ndarray, holds: np.ndarray, percent: int = PERCENT) -> list[int]:
        """The sets similar to the query, itself included; `holds` marks the query's elements."""
        found, size = [], len(query)
        walk = [(child, 0) for child in self.root[2]]
        while walk:
            (edge, depth, children, ends, least, most), overlap = walk.pop()
            if percent * max(size, least) > 100 * min(size, most):
                continue
            overlap += int(np.count_nonzero(holds[edge]))
            # 100 o >= p (|x| + |y| - o) for the best that can still follow on either side.
            if (100 + percent) * (overlap + most - depth) < percent * (size + most):
                continue
            rest = size - int(np.searchsorted(query, edge[-1], side="right")) if len(edge) else size
            if (100 + percent) * (overlap + rest) < percent * (size + least):
                continue
            if ends is not None and (100 + percent) * overlap >= percent * (size + depth):
                found.append(ends)
            walk += [(child, overlap) for child in children]
        return found


def spanning_links(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links between distinct sets that connect all that are connected; each link given is a true one."""
    if len(sets) < 2:
        return []
    elements, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(elements), np.int64)
    rank[np.lexsort((elements, -counts))] = np.arange(len(elements))  # one order for all sets: shared elements first
    ends = np.cumsum([len(s) for s in sets])
    ranked = [np.sort(r) for r in np.split(rank[inverse], ends[:-1])]
    tree = PrefixTree(ranked)
    weight = [int(c.sum()) / max(len(c), 1) for c in np.split(counts[inverse], ends[:-1])]
    group = np.arange(len(sets))
    holds = np.zeros(len(elements), bool)
    links = []
    # The set with the most common elements first: in a group of near copies it links most of them.
    waiting = sorted(range(len(sets)), key=lambda k: (-weight[k], k))
    while waiting:
        skipped = []
        for query in waiting:
            if links and group[query] == np.bincount(group).argmax():
                skipped.append(query)  # a link out of the largest group has its other end outside, and that end searches
                continue
            holds[ranked[query]] = True
            for other in tree.similar(ranked[query], holds, percent):
                if group[other] != group[query]:
                    links.append((query, other))
                    group[group == group[other]] = group[query]
            holds[ranked[query]] = False
        # Another group may have become the largest since: both ends of a link can have been skipped. Sets skipped wait
        # again until all of them lie in the group that is the largest at the end.
        waiting = skipped if (group[skipped] != np.bincount(group).argmax()).any() else []
    return links


def _cell_links(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = []
    for _, cell in pdf.groupby(["block", "low", "high"], sort=False):
        cell = cell.drop_duplicates("node")
        nodes = cell.node.tolist()
        rows += [(nodes[a], nodes[b]) for a, b in spanning_links(shingle_sets(cell.text.tolist()))]
    return pd.DataFrame(rows, columns=["a", "b"]).astype("int64")


def _class_texts(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes with the text of their first document. A map of fixed size keeps other texts from moving."""
    key = F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), "text_key")
    bit = F.pmod(key, F.lit(MAP_BITS))
    bits = classes.select((bit / 32).cast("int").alias("word"), (bit % 32).cast("int").alias("place"))
    words = bits.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, place))").alias("bits"))
    bitmap = np.zeros(MAP_BITS // 32, np.uint32)
    for row in words.toLocalIterator():  # MAP_BITS / 32 rows at most
        bitmap[row.word] = row.bits
    shared = documents.sparkSession.sparkContext.broadcast(bitmap)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("bit").to_numpy()
            yield batch.filter(pa.array((shared.value[at // 32] >> (at % 32).astype(np.uint32)) & 1 == 1))

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), F.xxhash64(whole_text()).alias("text_key")
    ).withColumn("bit", bit)
    kept = rows.mapInArrow(wanted, rows.schema)
    same = kept["doc_id"].eqNullSafe(classes["doc_id"]) & (kept["text_key"] == classes["text_key"])
    return kept.join(classes, same).select("node", "block", "text")


def linked_nodes(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component) of all nodes that are linked with another one."""
    blocks = frozen(components(nodes.select(F.col("node").alias("a"), F.explode("hubs").alias("b"))), "blocks").withColumnRenamed("component", "block")
    held = frozen(nodes.join(blocks, "node").select("node", "block", "doc_id", "text_key", "digest"), "block-nodes")
    classes = held.groupBy("block", "digest").agg(F.min(F.struct("node", "doc_id", "text_key")).alias("first"))
    classes = frozen(classes.select("block", "digest", "first.*"), "classes")
    sizes = classes.groupBy("block").agg(F.count("*").alias("sets")).where("sets > 1")
    texts_ = _class_texts(documents, frozen(classes.join(sizes.select("block"), "block", "left_semi"), "compared"))
    parts = F.ceil(F.col("sets") / CELL_SETS).cast("int")
    dealt = texts_.join(sizes, "block").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    cells = (
        dealt.withColumn("other", F.explode(others))
        .where("parts = 1 OR other != part")
        .select("block", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "node", "text")
    )
    # Many small cells share a group; a cell itself is never cut.
    groups = max(64, classes.count() // 100)
    cells = cells.withColumn("group", F.pmod(F.xxhash64("block", "low", "high"), F.lit(groups)))
    links = cells.groupBy("group").applyInPandas(_cell_links, "a long, b long")
    same_set = held.join(classes.select("block", "digest", F.col("node").alias("b")), ["block", "digest"]).select(F.col("node").alias("a"), "b")
    return components(links.unionAll(same_set.where("a != b")))


def join_documents(documents: DataFrame) -> DataFrame:
    """Per row node, doc_id, text_key, n_shingles, component_id and whether the row is the one of its component to keep."""
    nodes = candidate_nodes(documents)
    linked = frozen(linked_nodes(documents, nodes), "linked")
    known = frozen(nodes.drop("hubs", "digest").join(linked, "node", "left"), "known")
    # The smallest id of each component, and the first row that has it.
    first = known.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("smallest"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("kept"))
    first = frozen(first.select("component", "smallest", F.col("kept.node").alias("kept")), "first")
    alone = F.col("component").isNull()
    return known.join(first, "component", "left").select(
        "node",
        "doc_id",
        "text_key",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
        (alone | (F.col("node") == F.col("kept"))).alias("stays"),
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents, all columns, with one row of each component left: the first row with the smallest id."""
    own = ("text_key", "spot", "wanted", "wanted_id", "wanted_key")
    key, spot, wanted, wanted_id, wanted_key = (free_name(documents, name) for name in own)
    decided = join_documents(documents).where("stays").groupBy("doc_id", "text_key").agg(F.count("*").alias(wanted))
    decided = decided.withColumnRenamed("doc_id", wanted_id).withColumnRenamed("text_key", wanted_key)
    keyed = documents.withColumn(key, F.xxhash64(whole_text()))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(wanted_id)) & (F.col(key) == F.col(wanted_key))
    met = keyed.join(decided, same)
    # Rows with one id and one text differ in no way that the join knows: as many stay as it keeps.
    rank = F.row_number().over(Window.partitionBy("doc_id", key).orderBy(F.lit(0)))
    return met.withColumn(spot, rank).where(F.col(spot) <= F.col(wanted)).select(documents.columns)
