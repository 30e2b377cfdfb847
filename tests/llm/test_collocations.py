"""Collocations against plain counting of every phrase."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tierflow.llm import collocations as c

from .cases import EXTRA, edge_texts

SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}, phrase string, need string, shard string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, *["x"] * 12) for i, t, lang in rows], SCHEMA)


def plain(rows, support, longest=5, top=2000, hiding=100):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        kept = {p: n for p, n in f.items() if n >= support and len(p) > 1}
        hidden = {
            p[i : i + m]
            for p, n in kept.items()
            for m in range(2, len(p))
            for i in range(len(p) - m + 1)
            if 100 * n >= hiding * f[p[i : i + m]]
        }
        scored = []
        for p, a in kept.items():
            if p in hidden:
                continue
            score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def corpus(seed, n=300):
    random_ = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Über", "été", "Wörter", "東京", "x-1", "a"]
    phrases = [["new", "york", "city"], ["in", "the", "long", "run", "we"], ["a", "a", "a"], ["東京", "タワー"]]
    rows = []
    for i in range(n):
        text = []
        for _ in range(random_.randrange(0, 30)):
            text += random_.choice(phrases) if random_.random() < 0.2 else [random_.choice(words)]
            text.append(random_.choice(["", "", "", "", ",", ". ", "\n", "!?"]))
        lang = random_.choice(["en", "en", "de", None])
        rows.append((i, " ".join(text).replace("  ", random_.choice([" ", "\t", "  "])).replace("new", random_.choice(["new", "NEW"])), lang))
    return rows


def got(spark, rows, **options):
    return sorted(tuple(r) for r in c.collocations(frame(spark, rows), **options).collect())


@pytest.mark.parametrize(("seed", "support"), [(1, 10), (2, 25)])
def test_equals_plain_counting(spark, seed, support):
    rows = corpus(seed)
    rows += [(1000 + i, t, "en") for i, t in enumerate(edge_texts())]
    want = plain(rows, support)
    assert len(want) > 10
    assert got(spark, rows, support=support) == want


def test_shards_support_and_parts(spark, monkeypatch):
    rows = corpus(3)
    want = plain(rows, 12, longest=4, top=5)
    for shards, part in [(1, 1 << 20), (3, 200), (40, 1000)]:
        monkeypatch.setattr(c, "PART_BYTES", part)
        assert got(spark, rows, support=12, longest=4, top=5, shards=shards) == want


def test_a_full_bitmap_only_costs_work(spark, monkeypatch):
    monkeypatch.setattr(c, "MIN_FILTER_BITS", 64)
    monkeypatch.setattr(c, "FILTER_BITS", 64)
    rows = corpus(4, 120)
    assert got(spark, rows, support=8) == plain(rows, 8)


def test_hidden_phrases_and_overlaps(spark):
    rows = [(i, "red green blue. a a a a, red green", "en") for i in range(4)] + [(9, "green blue", "en")]
    want = plain(rows, 4)
    assert got(spark, rows, support=4) == want
    phrases = {row[2] for row in want}
    # `green blue` occurs once more than the phrase that holds it; `a a a` is in `a a a a` but occurs twice as often.
    assert {"red green blue", "red green", "green blue", "a a", "a a a", "a a a a"} <= phrases
    assert got(spark, rows, support=4, hiding=50) == plain(rows, 4, hiding=50)


def test_hot_ids_repeats_and_very_frequent_words(spark):
    rows = [(7, "spam spam spam eggs", "en")] * 60 + [(None, "spam eggs", None)] * 30 + [(i, None, None) for i in range(5)]
    assert got(spark, rows, support=20) == plain(rows, 20)


def test_no_rows(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, "a b c", "en"), (2, None, "en"), (3, " \t\n", None)]) == []


def test_scores_beyond_64_bits(spark):
    big = 10**13
    counts = spark.createDataFrame([("en", "x y", 2, big), ("en", "x", 1, 2 * big), ("en", "y", 1, 3 * big)], "lang string, phrase string, words int, f long")
    totals = spark.createDataFrame([("en", 10**16)], "lang string, n long")
    row = c.scored(counts, totals).first()
    assert row["score"] == 1000 * big * 10**16 // (6 * big * big)
