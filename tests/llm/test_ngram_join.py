import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierflow.llm import ngram_join
from tierflow.llm.components import components
from tierflow.llm.ngram_join import PrefixTree, join_documents, keep_one, shingle_sets, spanning_links

from .cases import edge_texts, frame, prose


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def groups(sets):
    """Component of each set by its smallest place."""
    top = list(range(len(sets)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, j in combinations(range(len(sets)), 2):
        if linked(sets[i], sets[j]):
            a, b = find(i), find(j)
            top[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(sets))]


def edited(text, seed, share):
    random_ = random.Random(seed)
    return " ".join("zz%d" % random_.randrange(10**6) if random_.random() < share else w for w in text.split())


def corpus():
    texts = []
    for family in range(12):
        base = prose(family, 30 + 17 * family)
        texts += [base, base.upper(), *(edited(base, 31 * family + k, 0.02) for k in range(6)), *(edited(base, k, 0.06) for k in range(3))]
    shared = prose(99, 60)
    texts += [prose(200 + k, 80) + " " + shared for k in range(25)]  # a passage that many share
    texts += ["a b c", "A B  C", "a b", "one two three four five", "one two three four five six"]
    return texts + [t for t in edge_texts()]


def test_components_equal_brute_force(spark):
    texts = corpus()
    want = groups([shingles(t) for t in texts])
    rows = join_documents(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.n_shingles == len(shingles(texts[row.doc_id]))
        assert row.component_id == want[row.doc_id], row.doc_id


def test_cells_of_a_large_block(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL_SETS", 7)
    base = prose(1, 120)
    texts = [base, *(edited(base, k, 0.015) for k in range(60))]
    want = groups([shingles(t) for t in texts])
    got = {r.doc_id: r.component_id for r in join_documents(frame(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == want
    assert len(set(want)) < len(texts)


def test_keep_one(spark):
    texts = corpus()
    docs = frame(spark, texts)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups([shingles(t) for t in texts])))


def test_repeated_and_null_ids(spark):
    text = prose(5, 50)
    rows = join_documents(frame(spark, [text, text, text, prose(6, 50), None, ""], ids=[None, 4, 4, None, 2, 2])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id is None, r.component_id or 0) for r in rows) == [
        (False, 2, False, 2), (False, 2, False, 2), (False, 4, False, 4), (False, 4, False, 4), (True, 0, False, 4), (True, 0, True, 0)
    ]
    kept = keep_one(frame(spark, [text, text, text, prose(6, 50)], ids=[None, 4, 4, None])).collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, 4]


def test_empty_tables(spark):
    assert join_documents(frame(spark, [])).count() == 0
    assert keep_one(frame(spark, [])).count() == 0
    assert [r.component_id for r in join_documents(frame(spark, [None, ""])).orderBy("doc_id").collect()] == [0, 1]


SETS = st.lists(st.frozensets(st.integers(0, 14), min_size=1, max_size=9), min_size=2, max_size=14, unique=True)


@settings(max_examples=200, deadline=None)
@given(SETS)
def test_prefix_tree_finds_all_similar_sets(sets):
    ranked = [np.array(sorted(s)) for s in sets]
    tree = PrefixTree(ranked)
    for k, query in enumerate(sets):
        holds = np.zeros(15, bool)
        holds[list(query)] = True
        assert sorted(tree.similar(ranked[k], holds)) == [j for j, other in enumerate(sets) if linked(query, other)]


@settings(max_examples=200, deadline=None)
@given(SETS)
def test_spanning_links_connect_what_is_connected(sets):
    links = spanning_links([np.array(sorted(s), np.uint64) for s in sets])
    assert all(linked(sets[a], sets[b]) for a, b in links)
    want = groups(sets)
    top = list(range(len(sets)))
    for _ in sets:
        for a, b in links:
            top[a] = top[b] = min(top[a], top[b])
    assert top == want


def bridge():
    """Two families of near copies that only one pair joins, beside sets that share passages with them."""
    passage, own, other, new = list(range(10)), list(range(10, 40)), list(range(40, 45)), iter(range(100, 10_000))

    def swapped(held, gone, to=None):
        return frozenset(held) - set(gone) | set(to or [next(new) for _ in gone])

    first = frozenset(passage + own)
    x = swapped(first, passage[:5])
    y = swapped(x, passage[5:])
    last = swapped(y, own[:5], other)
    small = [first, x, *(swapped(first, [k]) for k in own[5:8])]
    large = [last, y, *(swapped(last, [k]) for k in own[8:14])]
    beside = [frozenset(p) | {next(new) for _ in range(30)} for p in [passage] * 30 + [other] * 15]
    return [*small, *large, *beside]


def test_a_single_pair_joins_two_families():
    sets = bridge()
    links = spanning_links([np.array(sorted(s), np.uint64) for s in sets])
    assert all(linked(sets[a], sets[b]) for a, b in links)
    want = groups(sets)
    assert want[:13] == [0] * 13 and len(set(want)) == 46
    top = list(range(len(sets)))
    for _ in sets:
        for a, b in links:
            top[a] = top[b] = min(top[a], top[b])
    assert top == want


def test_shingles_equal_words():
    a, b, c = shingle_sets(["One two three four five six", "one TWO\tthree\nfour five six", "one two three four five"])
    assert np.array_equal(a, b) and len(a) == 2 and len(c) == 1 and c[0] in a


def test_connected_components(spark):
    random_ = random.Random(4)
    links = [(random_.randrange(300), random_.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in list(top)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_group_spreads(spark):
    """A third of all rows are near copies: the classes meet in many cells of bounded size, and all are found."""
    base = prose(3, 90)
    texts = [edited(base, k, 0.01) for k in range(300)] + [prose(1000 + k, 40) for k in range(600)]
    got = join_documents(frame(spark, texts)).where(F.col("doc_id") < 300).groupBy("component_id").count().orderBy(F.desc("count")).first()
    want = groups([shingles(t) for t in texts[:300]])
    assert got["count"] == max(want.count(x) for x in set(want))


@pytest.mark.parametrize("n", range(1, 60))
def test_prefix_length(n):
    need = -(-75 * n // 100)
    assert ngram_join.prefix_length(np.array([n]))[0] == n - need + 1
