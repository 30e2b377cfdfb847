"""SentencePiece segmentation: the N best over the piece lattice, and decoding.

The lattice of a text has a place between any two characters and an arc for every piece that stands there, with the
model's score; a character without a piece is an unknown arc, written as its bytes. A forward Viterbi pass gives for each
place the best score from the text's start. A backward A-star search from the end takes this score as its heuristic. It is
exact, so paths come out in order of their total, and the search never opens a place that none of the N best needs.

No piece reaches from a visible character into the blank that follows it, and many neighbouring characters occur together
in no piece at all. There the lattice falls apart into lattices of short chunks, and the best path of the text is the best
path of every chunk. The N best of the text differ from it in few chunks: only the N - 1 cheapest single changes can take
part, and their combinations are ordered by total. Chunks recur, so a task keeps what it found for them (bounded).

Of most chunks only the best path and the cost of the cheapest change are needed. The new chunks of many texts get them
together, one step for all chunks of a length: a Viterbi pass from either end gives the best total through every arc, and the
best one through an arc beside the best path is the second best path's. The A-star search is left to chunks that may change.

Defined results: a null text is the empty text: one segmentation without pieces, score 0. Texts with fewer than N
segmentations have fewer. Equal totals come in a fixed order: the best path first, then changes nearer the text's start.
Every input row gives one output row, repeated rows and null ids included. The character U+2581 in a text is a blank after
decoding, as in the format itself. An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import slices, texts

MODEL = "piece_bpe_32k.model"
BEST = 4
# What a task keeps of chunks and their parts, in each of two generations.
KEPT_CHUNKS = 300_000
KEPT_PARTS = 150_000
KEPT_FULL = 20_000
# Longer texts are not kept, and searched one at a time.
SHORT = 32
# Chunks searched together have at most this many arcs, and texts segmented together this many bytes.
BLOCK_ARCS = 1_000_000
GROUP_BYTES = 2_000_000
BLANK = chr(0x2581)
_UNKNOWN_PENALTY = 10.0

_CHUNKS = re.compile("\n| *[^ \n]+| +")


class Lattice:
    """Pieces and scores of a model, and the N best segmentations of a chunk."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.names = {i: model.id_to_piece(i) for i in plain}
        self.arcs = {name: (i, model.get_score(i)) for i, name in self.names.items()}
        self.longest = max(map(len, self.arcs))
        self.unknown_score = min(score for _, score in self.arcs.values()) - _UNKNOWN_PENALTY
        # Whole numbers add up exactly in any order, so that equal totals are equal in every search.
        self.exact = all(float(score).is_integer() for _, score in self.arcs.values())
        self.bytes = {b: model.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        # The score of each id; an unknown character's is on its first byte, so ids alone give the total.
        self.scores = np.zeros(model.get_piece_size())
        for piece, score in self.arcs.values():
            self.scores[piece] = score
        for byte, piece in self.bytes.items():
            self.scores[piece] = 0.0 if 0x80 <= byte < 0xC0 else self.unknown_score
        self.as_bytes = [b""] * model.get_piece_size()
        for i, name in [*((i, name.encode()) for i, name in self.names.items()), *((i, bytes([b])) for b, i in self.bytes.items())]:
            self.as_bytes[i] = name
        # The pieces by their characters: a node leads on by the next character, and at "" has the arc of the piece it ends.
        self.tree: dict = {}
        for name, arc in self.arcs.items():
            node = self.tree
            for character in name:
                node = node.setdefault(character, {})
            node[""] = arc
        # The tree as arrays: the steps (node, next character) in order, the k-th of which leads to node k + 1.
        nodes, steps = [self.tree], []
        for k, node in enumerate(nodes):
            for character in sorted(filter(None, node)):
                steps.append(k << 21 | ord(character))
                nodes.append(node[character])
        self.steps = np.array([*steps, 1 << 62])
        self.node_pieces = np.array([node[""][0] if "" in node else -1 for node in nodes], np.int32)
        self.node_scores = np.array([node[""][1] if "" in node else -np.inf for node in nodes])
        # Pairs of neighbours inside any piece; between other pairs the lattice falls apart.
        self.pairs = {name[k : k + 2] for name in self.arcs for k in range(len(name) - 1)}

    def parts(self, chunk: str) -> list[str]:
        """The chunk cut wherever no piece spans the two neighbours."""
        cuts = [0, *(k for k in range(1, len(chunk)) if chunk[k - 1 : k + 1] not in self.pairs), len(chunk)]
        return [chunk[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def best(self, chunk: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best (score, ids); an unknown character counts as the ids of its bytes."""
        size = len(chunk)
        forward = [float("-inf")] * (size + 1)
        forward[0] = 0.0
        ending: list[list] = [[] for _ in range(size + 1)]
        arcs, tree = self.arcs, self.tree
        for start in range(size):
            so_far, node, end = forward[start], tree, start
            for character in chunk[start : start + self.longest]:
                node = node.get(character)
                if node is None:
                    break
                end += 1
                if "" in node:
                    piece, score = node[""]
                    ending[end].append((start, piece, score))
                    if so_far + score > forward[end]:
                        forward[end] = so_far + score
            if chunk[start] not in arcs:
                ending[start + 1].append((start, -1 - ord(chunk[start]), self.unknown_score))
                if so_far + self.unknown_score > forward[start + 1]:
                    forward[start + 1] = so_far + self.unknown_score
        # Entries: minus the best total through here, age (younger first among equals), place, score behind, path behind.
        heap = [(-forward[size], 0, size, 0.0, None)]
        found, age = [], 0
        while heap and len(found) < n:
            total, _, place, behind, path = heapq.heappop(heap)
            if place == 0:
                found.append((-total, self._ids(path)))
                continue
            for start, piece, score in ending[place]:
                age -= 1
                heapq.heappush(heap, (-(behind + score + forward[start]), age, start, behind + score, (piece, path)))
        return found

    def cheapest(self, chunks: list[str]) -> list[tuple[bytes, float]]:
        """Per chunk the ids of the first of `best` as bytes, and what the second costs more (without one: infinity).

        Plain blanks may stand for BLANK.
        """
        out: list = [None] * len(chunks)
        lengths: dict[int, list[int]] = {}
        for k, chunk in enumerate(chunks):
            lengths.setdefault(len(chunk), []).append(k)
        for size, places in lengths.items():
            room = max(1, BLOCK_ARCS // (size * min(size, self.longest)))
            for at in range(0, len(places), room):
                block = places[at : at + room]
                for k, found in zip(block, self._cheapest([chunks[k] for k in block], size), strict=True):
                    out[k] = found
        return out

    def _cheapest(self, chunks: list[str], size: int) -> list[tuple[bytes, float]]:
        """The same for chunks of one length. Arrays go by place (or length and place of an arc's start), then by chunk."""
        n = len(chunks)
        characters = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64).reshape(n, size).T.ravel()
        characters[characters == ord(" ")] = ord(BLANK)
        # The nodes of the arcs, 0 where no piece goes on.
        nodes = np.zeros((min(size, self.longest), size * n), np.int32)
        starts, node, depth = np.arange(size * n), np.zeros(size * n, np.int64), 0
        while len(starts) and depth < len(nodes):
            step = node << 21 | characters[starts + depth * n]
            node = np.searchsorted(self.steps, step)
            known = self.steps[node] == step
            starts, node = starts[known], node[known] + 1
            nodes[depth, starts] = node
            depth += 1
            inside = np.searchsorted(starts, (size - depth) * n)
            starts, node = starts[:inside], node[:inside]
        nodes = nodes[:depth].reshape(depth, size, n)
        scores = self.node_scores[nodes]
        scores[0][np.isneginf(scores[0])] = self.unknown_score
        forward, backward = np.full((2, size + 1, n), -np.inf)
        forward[0] = backward[size] = 0.0
        # The length of the best arc to a place; of equal ones the shortest, which the search opens first.
        last = np.zeros((size + 1, n), np.int64)
        for start in range(size):
            reach = slice(start + 1, start + 1 + depth)
            totals = scores[: size - start, start] + forward[start]
            better = totals >= forward[reach]
            np.copyto(forward[reach], totals, where=better)
            np.copyto(last[reach], np.arange(1, len(totals) + 1)[:, None], where=better)
        for start in reversed(range(size)):
            backward[start] = (scores[: size - start, start] + backward[start + 1 : start + 1 + depth]).max(0)
        # The piece that starts at a place on the best path (-1: none, below: an unknown character), and the path's arcs put out.
        pieces = np.full((n, size), -1, np.int64)
        row, place = np.arange(n), np.full(n, size)
        while len(row):
            length = last[place, row]
            place = place - length
            piece = self.node_pieces[nodes[length - 1, place, row]]
            pieces[row, place] = np.where(piece < 0, -2 - characters[place * n + row], piece)
            scores[length - 1, place, row] = -np.inf
            row, place = row[place > 0], place[place > 0]
        second = np.full(n, -np.inf)
        for start in range(size):
            beside = (scores[: size - start, start] + backward[start + 1 : start + 1 + depth]).max(0)
            np.maximum(second, beside + forward[start], out=second)
        ends = 4 * np.cumsum((pieces != -1).sum(1))
        ids = pieces[pieces != -1].astype("<i4").tobytes()
        out = [(ids[a:b], cost) for a, b, cost in zip([0, *ends.tolist()], ends.tolist(), (forward[size] - second).tolist(), strict=False)]
        for k in np.flatnonzero((pieces < -1).any(1)).tolist():
            path = None
            for piece in reversed(pieces[k][pieces[k] != -1].tolist()):
                path = (piece + 1 if piece < 0 else piece, path)
            out[k] = (np.array(self._ids(path), "<i4").tobytes(), out[k][1])
        return out

    def _ids(self, path) -> list[int]:
        ids = []
        while path is not None:
            piece, path = path
            if piece >= 0:
                ids.append(piece)
            else:
                ids += [self.bytes[b] for b in chr(-1 - piece).encode("utf-8", "surrogatepass")]
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of some ids: pieces in a row, the blank that encoding puts before the text taken off."""
        text = b"".join(map(self.as_bytes.__getitem__, ids)).decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if text.startswith(" ") else text


class Kept(dict):
    """Results by text, in two generations: when the young one is full it becomes the old one, and what is used moves up.

    So common texts stay and memory is bounded; texts of more than 32 characters are not kept.
    """

    def __init__(self, find: Callable[[list[str]], list], room: int):
        self.find, self.room, self.old = find, room, {}

    def __missing__(self, text: str):
        return self.of([text])[text]

    def of(self, texts: Iterable[str]) -> dict:
        """The results of some texts; those that are not kept are found together."""
        texts = list(dict.fromkeys(texts))
        found = dict(zip(texts, map(self.get, texts), strict=True))
        late = [text for text, result in found.items() if result is None]
        found.update(zip(late, map(self.old.get, late), strict=True))
        new = [text for text in late if found[text] is None]
        found.update(zip(new, self.find(new), strict=True))
        for text in late:
            if len(text) <= SHORT:
                if len(self) >= self.room:
                    self.old = dict(self)
                    self.clear()
                self[text] = found[text]
        return found


class Chunks:
    """The N best segmentations of texts; chunks are solved once while they are kept."""

    def __init__(self, lattice: Lattice, n: int):
        self.lattice, self.n = lattice, n
        self.parts = Kept(self._of_parts, KEPT_PARTS)
        self.full = Kept(lambda parts: [lattice.best(part, n) for part in parts], KEPT_FULL)
        self.chunks = Kept(self._of_chunks, KEPT_CHUNKS)

    def _of_parts(self, parts: list[str]) -> list[tuple[bytes, float]]:
        """(ids as bytes, cost of the cheapest change); all N are searched only where a text may need them."""
        short = [part for part in parts if len(part) <= SHORT and self.lattice.exact]
        if len(short) == len(parts):
            return self.lattice.cheapest(parts)
        known = dict(zip(short, self.lattice.cheapest(short), strict=True))
        for part in parts:
            if part not in known:
                found = self.lattice.best(part.replace(" ", BLANK), min(self.n, 2))
                known[part] = (np.array(found[0][1], "<i4").tobytes(), found[0][0] - found[1][0] if len(found) > 1 else np.inf)
        return [known[part] for part in parts]

    def _of_chunks(self, chunks: list[str]) -> list[tuple[bytes, float]]:
        """The same of chunks, which still have their plain blanks. Long ones are put together from their parts."""
        long = {chunk: self.lattice.parts(chunk.replace(" ", BLANK)) for chunk in chunks if len(chunk) > SHORT}
        short = iter(self._of_parts([chunk for chunk in chunks if len(chunk) <= SHORT]))
        if not long:
            return list(short)
        known = self.parts.of(chain.from_iterable(long.values()))
        return [(b"".join([known[p][0] for p in long[c]]), min([known[p][1] for p in long[c]])) if c in long else next(short) for c in chunks]

    def segment(self, text: str) -> tuple[np.ndarray, list[tuple[float, np.ndarray]]]:
        """Ids of the best segmentation, and the N best as (score, ids)."""
        return next(self.segment_all([text]))

    def segment_all(self, texts: list[str]) -> Iterator[tuple[np.ndarray, list[tuple[float, np.ndarray]]]]:
        """The same of every text; their new chunks are solved together."""
        cut = [_CHUNKS.findall(" " + (text.replace(BLANK, " ") if BLANK in text else text)) if text else [] for text in texts]
        known = self.chunks.of(chain.from_iterable(cut))
        for chunks in cut:
            yield self._segment(chunks, list(map(known.__getitem__, chunks)))

    def _segment(self, chunks: list[str], known: list[tuple[bytes, float]]) -> tuple[np.ndarray, list[tuple[float, np.ndarray]]]:
        if not chunks:
            return np.zeros(0, "<i4"), [(0.0, np.zeros(0, "<i4"))]
        ids = [k[0] for k in known]
        best = np.frombuffer(b"".join(ids), "<i4")
        score = float(self.lattice.scores[best].sum())
        if self.n == 1:
            return best, [(score, best)]
        return best, [(score, best), *self._others(chunks, ids, np.array([k[1] for k in known]), best, score)]

    def _others(self, chunks: list[str], ids: list[bytes], cheapest: np.ndarray, best: np.ndarray, score: float) -> list[tuple[float, np.ndarray]]:
        wanted = min(self.n - 1, len(chunks))
        limit = np.partition(cheapest, wanted - 1)[wanted - 1]
        # Chunks whose own cheapest change is among the first: all other changes cost more than these.
        some = np.flatnonzero((cheapest <= limit) & np.isfinite(cheapest))
        some = some[np.argsort(cheapest[some], kind="stable")][:wanted]
        changes = []
        for place in some.tolist():
            for k, part in enumerate(self.lattice.parts(chunks[place].replace(" ", BLANK))):
                found = self.full[part]
                changes += [(found[0][0] - score, place, k, other) for other, (score, _) in enumerate(found) if other]
        changes.sort()
        sums: list[tuple[float, tuple]] = [(0.0, ())]
        for change in changes[: self.n - 1]:
            more = [(cost + change[0], (*taken, change)) for cost, taken in sums if all(t[1:3] != change[1:3] for t in taken)]
            sums = sorted(sums + more, key=lambda s: (s[0], len(s[1]), s[1]))[: self.n]
        starts = {place: sum(map(len, ids[:place])) // 4 for place in {change[1] for change in changes[: self.n - 1]}}
        return [(score - cost, self._changed(chunks, ids, best, starts, taken)) for cost, taken in sums[1 : self.n]]

    def _changed(self, chunks: list[str], ids: list[bytes], best: np.ndarray, starts: dict[int, int], taken: tuple) -> np.ndarray:
        pieces, at = [], 0
        for place in sorted({t[1] for t in taken}):
            pieces.append(best[at : starts[place]])
            for k, part in enumerate(self.lattice.parts(chunks[place].replace(" ", BLANK))):
                other = next((t[3] for t in taken if t[1:3] == (place, k)), 0)
                pieces.append(np.array(self.full[part][other][1], "<i4"))
            at = starts[place] + len(ids[place]) // 4
        return np.concatenate([*pieces, best[at:]])


@lru_cache(maxsize=1)
def chunks_of(path: str, n: int) -> Chunks:
    return Chunks(Lattice(path), n)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def segment(documents: DataFrame, n: int = BEST, path: str | None = None) -> DataFrame:
    """Per row the best ids, whether they decode to the text, and score, pieces and checksum of the N best."""
    path = path or model_path()
    each = pa.struct([("score", pa.float64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_pieces", pa.int64()), ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_()), ("best", pa.list_(each))])

    def segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunks_of(path, n)
        for batch in batches:
            for part in slices(batch, "text", GROUP_BYTES):
                values = texts(part, "text")
                found = list(chunks.segment_all(values))
                ids = [f[0] for f in found]
                back = [chunks.lattice.decode(i.tolist()) == text for i, text in zip(ids, values, strict=True)]
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                best = [[{"score": score, "n_pieces": len(i), "ids_crc32": zlib.crc32(i.tobytes())} for score, i in f[1]] for f in found]
                arrays = [part.column("doc_id"), pa.array(map(len, values), pa.int64()), pa.array(map(len, ids), pa.int64()), flat, pa.array(back), pa.array(best, pa.list_(each))]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    columns = "doc_id long, n_chars long, n_pieces long, ids array<int>, round_trip boolean, best array<struct<score:double,n_pieces:long,ids_crc32:long>>"
    return narrow.mapInArrow(segmented, columns)
