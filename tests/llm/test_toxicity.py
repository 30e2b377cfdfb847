import os

import numpy as np
import pytest

from tierflow.llm import toxicity
from tierflow.llm.toxicity import drop_toxic, score, train, trained_chain

from .cases import edge_texts, frame, prose

LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(n):
    """Every third text is toxic, every second one of low quality; both show in words."""
    texts, marks = [], []
    for k in range(n):
        low, toxic = k % 2, int(k % 3 == 0)
        texts.append(" ".join([prose(k, 30), *(["rubbish"] * low), *(["vermin", "verminous"][k % 2 :] * toxic), prose(k + 10_000, 10)]))
        marks.append((low, toxic))
    return texts, np.array(marks, float)


def test_held_out_accuracy():
    texts, marks = corpus(400)
    chain = train(list(range(300)), texts[:300], marks[:300])
    known = chain.probabilities([toxicity.words_of(t) for t in texts[300:]])
    assert ((known >= 0.5) == (marks[300:] == 1)).mean() > 0.97


def test_later_links_use_earlier_probabilities():
    texts, marks = corpus(300)
    marks[:, 1] = marks[:, 0]  # the second category is the first one: nothing but its probability is needed
    chain = train(list(range(300)), texts, marks)
    assert chain.links[0].earlier.size == 0 and chain.links[1].earlier.size == 1
    assert chain.links[1].earlier[0] > 0


def test_earlier_probabilities_are_out_of_fold(monkeypatch):
    texts, marks = corpus(120)
    seen = []
    real = toxicity.fit

    def fit(matrix, earlier, labels, use, **more):
        seen.append((earlier.shape[1], int(use.sum())))
        return real(matrix, earlier, labels, use, **more)

    monkeypatch.setattr(toxicity, "fit", fit)
    train(list(range(120)), texts, marks)
    firsts = [n for links, n in seen if links == 0]
    assert firsts[0] == 120 and sum(120 - n for n in firsts[1:]) == 120  # each text is left out once


def test_queries_over_frames(spark):
    texts, marks = corpus(200)
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(k, int(1 - m[0]), int(m[1]), "clash") for k, m in enumerate(marks[:150])] + [(None, 1, 1, ""), (3, None, 0, ""), (9999, 0, 1, "")], LABELS)
    chain = trained_chain(docs, labels)
    got = {r.doc_id: r.toxic for r in score(docs, chain).collect()}
    assert np.mean([got[k] == (m[1] == 1) for k, m in enumerate(marks)]) > 0.97
    kept = drop_toxic(docs, chain)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, toxic in got.items() if not toxic}


def test_edges(spark):
    texts, marks = corpus(60)
    chain = train(list(range(60)), texts, marks)
    edges = frame(spark, edge_texts(), ids=[None, 1, 1, *range(3, 11)])
    assert score(edges, chain).count() == len(edge_texts())
    assert score(frame(spark, []), chain).count() == 0
    nothing = trained_chain(frame(spark, texts), spark.createDataFrame([], LABELS))
    assert not any(r.toxic for r in score(frame(spark, texts), nothing).collect())
    one_class = trained_chain(frame(spark, texts), spark.createDataFrame([(k, 1, 1, "") for k in range(60)], LABELS))
    assert all(r.toxic for r in score(frame(spark, texts), one_class).collect())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the driver's tables are not here")
def test_labelled_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    got = score(docs, trained_chain(docs, labels)).join(labels.select("doc_id", F_toxic()), "doc_id").collect()
    assert np.mean([r.toxic == (r.label == 1) for r in got]) > 0.95


def F_toxic():
    from pyspark.sql import functions as F

    return F.col("toxic").alias("label")
