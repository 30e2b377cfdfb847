import math
import random
import zlib
from collections import Counter

import numpy as np

from tierflow.llm import logbilinear
from tierflow.llm.logbilinear import Model, score_documents

from .cases import edge_texts, frame, prose


def brute(ids, texts):
    tokens = [[*(t or "").encode().lower().split(), None] for t in texts]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i in ids]
    counts = Counter(w for own, out in zip(tokens, held, strict=True) if not out for w in own)
    total, distinct = sum(counts.values()), len(counts)
    rows = []
    for own, out in zip(tokens, held, strict=True):
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        rows.append((out, len(own), sum(counts[w] > 0 for w in own), total, base))
    return rows


def check(spark, ids, texts, **sizes):
    got = sorted(score_documents(frame(spark, texts, ids), **sizes).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.n_tokens, r.base_score))
    want = sorted(zip(ids, brute(ids, texts), strict=True), key=lambda x: (x[0] is None, x[0], x[1][1], x[1][4]))
    assert len(got) == len(want)
    for row, (doc_id, (out, n, known, total, base)) in zip(got, want, strict=True):
        assert (row.doc_id, row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (doc_id, out, n, known, total)
        assert math.isclose(row.base_score, base, rel_tol=1e-9, abs_tol=1e-6)
        assert row.score <= 1e-3
    return got


def test_base_scores(spark):
    texts = edge_texts() + [prose(k, 50) for k in range(60)]
    check(spark, [None, 1, 1, *range(3, len(texts))], texts)


def test_words_beyond_the_head(spark):
    texts = [prose(k, 40) + " the The of" for k in range(50)]
    check(spark, list(range(50)), texts, head=20, classes=5)


def test_no_training_text_and_empty_table(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = check(spark, [held], ["a b"])[0]
    assert row.held_out and row.n_known == 0 and row.base_score == 0
    assert score_documents(frame(spark, [])).count() == 0


def test_probabilities_are_normalised():
    random_ = np.random.default_rng(2)
    model = Model.start(np.array([0, 5, 9, 4, 3, 2], float))
    model = Model(random_.normal(0, 1, model.context.shape), random_.normal(0, 1, model.target.shape), model.bias, random_.normal(0, 1, model.weights.shape))
    scores, normaliser = model.tables()
    for near in range(6):
        for far in range(6):
            p = np.exp(scores[0, near].astype(float) + scores[1, far] - normaliser[near, far])
            assert p[logbilinear.START] == 0 and abs(p.sum() - 1) < 1e-5


def test_the_start_model_is_the_unigram_model():
    counts = np.array([0, 10, 20, 30, 40], float)
    model = Model.start(counts)
    model.context[:] = 0
    scores, normaliser = model.tables()
    p = np.exp(scores[0, 1] + scores[1, 2] - normaliser[1, 2])
    assert np.allclose(p[1:], (counts[1:] + 0.5) / (counts[1:] + 0.5).sum(), atol=1e-5)


def chains(count, length=3000):
    """Texts in which each word is mostly followed by a fixed other one."""
    random_ = random.Random(6)
    words = [f"w{k}" for k in range(12)]

    def text(n):
        out = [random_.choice(words)]
        while len(out) < n:
            out.append(words[(words.index(out[-1]) + 1) % 12] if random_.random() < 0.9 else random_.choice(words))
        return " ".join(out)

    return [text(length) for _ in range(count)]


def test_context_helps_on_held_out_texts(spark):
    """The model learns which word follows, the unigram score cannot."""
    rows = score_documents(frame(spark, chains(120))).where("held_out").collect()
    assert sum(r.score for r in rows) > 0.75 * sum(r.base_score for r in rows)


def test_contexts():
    near, far = logbilinear.contexts(np.array([3, 4, 1, 5, 1, 1]), np.array([0, 3, 5]))
    assert near.tolist() == [0, 3, 4, 0, 5, 0] and far.tolist() == [0, 0, 3, 0, 0, 0]


def test_learning_does_not_depend_on_how_the_table_is_split(spark, monkeypatch):
    monkeypatch.setattr(logbilinear, "GROUP_TOKENS", 60_000)
    docs = frame(spark, chains(100, 1500))
    sums = []
    for parts in (1, 8):
        rows = score_documents(docs.repartition(parts)).where("held_out").collect()
        sums.append(sum(r.score for r in rows))
        assert sums[-1] > 0.75 * sum(r.base_score for r in rows)
    assert abs(sums[0] - sums[1]) < 0.01 * abs(sums[0])
