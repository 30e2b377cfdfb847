import random

import numpy as np
import pytest

from tierflow.llm import pieces
from tierflow.llm.pieces import BLANK, Chunks, Lattice, model_path, segment

from .cases import edge_texts, frame


@pytest.fixture(scope="module")
def lattice():
    return Lattice(model_path())


def every(lattice, text):
    """All segmentations of a text, best first."""
    whole, out = BLANK + text.replace(" ", BLANK), []

    def go(at, score, ids):
        if at == len(whole):
            out.append((score, ids))
            return
        for end in range(at + 1, min(len(whole), at + lattice.longest) + 1):
            if (arc := lattice.arcs.get(whole[at:end])) is not None:
                go(end, score + arc[1], (*ids, arc[0]))
        if whole[at] not in lattice.arcs:
            go(at + 1, score + lattice.unknown_score, (*ids, *(lattice.bytes[b] for b in whole[at].encode())))

    go(0, 0.0, ())
    return sorted(out, key=lambda x: -x[0])


def test_n_best_equal_brute_force(lattice):
    random_ = random.Random(3)
    fixed = ["a", "the cat", "é ç", "x  y", "\n", " ", "aaaa", "1,2!", "hé漢😀 a", "of of", "un un un", "   "]
    for text in fixed + ["".join(random_.choices("aetn éo. \n", k=random_.randint(1, 11))) for _ in range(200)]:
        want = every(lattice, text)
        for n in (1, 4, 7):
            best, found = Chunks(lattice, n).segment(text)
            assert [score for score, _ in found] == [score for score, _ in want[:n]]
            got = [tuple(ids.tolist()) for _, ids in found]
            assert len(set(got)) == len(got) and set(got) <= {ids for _, ids in want}
            assert got[0] == tuple(best.tolist())


def test_search_opens_few_places(lattice):
    """Long chunks without a blank stay quick: the heuristic is exact."""
    found = lattice.best("the" * 3000, 4)
    assert len(found) == 4 and found[0][0] >= found[-1][0]


def test_new_chunks_are_solved_together(lattice, monkeypatch):
    """The search runs for the few chunks that a text's N best may change, not for every new one."""
    random_ = random.Random(5)
    words = sorted({"".join(random_.choices("etaoinshrdlu", k=random_.randint(3, 12))) for _ in range(3000)})
    searched, search = [], lattice.best
    monkeypatch.setattr(lattice, "best", lambda chunk, n: searched.append(chunk) or search(chunk, n))
    best, found = Chunks(lattice, 4).segment(" ".join(words))
    assert len(words) > 2500 and len(found) == 4 and len(searched) < 20
    assert lattice.decode(best.tolist()) == " ".join(words)


def test_chunks_solved_together_equal_the_search(lattice):
    random_ = random.Random(7)
    letters = [*"aetnoirs.,1é", BLANK, "漢", "\U0001f600", "\u0378"]
    chunks = ["".join(random_.choices(letters, k=random_.randint(1, 32))) for _ in range(1500)] + ["a", "\u0378", BLANK * 32, "a" * 32, "un" * 16]
    for chunk, (ids, cost) in zip(chunks, lattice.cheapest(chunks), strict=True):
        found = lattice.best(chunk, 2)
        assert np.frombuffer(ids, "<i4").tolist() == found[0][1]
        assert cost == (found[0][0] - found[1][0] if len(found) > 1 else np.inf)


def test_texts_together_equal_texts_alone(lattice, monkeypatch):
    """Also when fewer chunks are kept than the texts have, and chunks are longer than those that are kept."""
    monkeypatch.setattr(pieces, "KEPT_CHUNKS", 7)
    monkeypatch.setattr(pieces, "KEPT_PARTS", 5)
    monkeypatch.setattr(pieces, "BLOCK_ARCS", 300)
    texts = [text or "" for text in edge_texts() if len(text or "") < 50_000] + ["漢字" * 40 + " the cat", "the cat é ç" * 9, "x1y2" * 30]
    together = Chunks(lattice, 4)
    for _ in range(2):
        for text, (best, found) in zip(texts, together.segment_all(texts), strict=True):
            alone_best, alone = Chunks(lattice, 4).segment(text)
            assert best.tolist() == alone_best.tolist()
            assert [(score, ids.tolist()) for score, ids in found] == [(score, ids.tolist()) for score, ids in alone]


def test_scores_that_are_not_whole_numbers_are_left_to_the_search(lattice, monkeypatch):
    text = "the cat é ç of of " + "un" * 30
    want = [(score, ids.tolist()) for score, ids in Chunks(lattice, 4).segment(text)[1]]
    assert lattice.exact
    monkeypatch.setattr(lattice, "exact", False)
    monkeypatch.setattr(lattice, "cheapest", lambda chunks: chunks and pytest.fail("not exact"))
    assert [(score, ids.tolist()) for score, ids in Chunks(lattice, 4).segment(text)[1]] == want


def test_round_trip(spark):
    texts = edge_texts()
    rows = segment(frame(spark, texts, ids=[None, 1, 1, *range(3, 11)])).collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    empty = [r for r in rows if r.n_chars == 0]
    assert all(r.n_pieces == 0 and [(b.score, b.n_pieces) for b in r.best] == [(0.0, 0)] for r in empty)
    for r in rows:
        assert r.n_pieces == len(r.ids) == r.best[0].n_pieces and len(r.best) <= 4
        assert [b.score for b in r.best] == sorted((b.score for b in r.best), reverse=True)


def test_decoding_agrees_with_the_library(lattice):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    for text in ["Hello  wörld\n x", "  a ", "漢字 😀", "a\tb", "plain words here"]:
        assert lattice.decode(model.encode(text)) == text == model.decode(model.encode(text))
        assert model.decode(Chunks(lattice, 1).segment(text)[0].tolist()) == text


def test_marker_becomes_a_blank_and_empty_table(spark):
    row = segment(frame(spark, [f"a{BLANK}b"])).first()
    assert not row.round_trip
    assert segment(frame(spark, [])).count() == 0
