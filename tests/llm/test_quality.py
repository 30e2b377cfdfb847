import re
from collections import Counter

import pytest

from tierflow.llm import quality
from tierflow.llm.quality import RULES, Rule, Text, cascade, judge, keep_good, passes

from .cases import edge_texts, frame, prose


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    dup = sum(line in lines[:k] for k, line in enumerate(lines))
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), failed


def junk():
    return [
        " ".join(w + "###" for w in prose(3, 50).split()),
        " | ".join(prose(4, 60).split()),
        "\n".join([prose(5, 4)] * 30),
        " ".join(["word"] * 80),
        "one line here\n" * 3 + prose(6, 40),
        prose(7, 30) + " " + prose(7, 30),
    ]


def test_base_measures(spark):
    texts = edge_texts()[:5] + edge_texts()[6:] + junk() + [prose(9, 20), prose(9, 19)]
    got = judge(frame(spark, texts)).collect()
    assert len(got) == len(texts)
    for row, text in zip(sorted(got, key=lambda r: r.doc_id), texts, strict=True):
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == brute(text)


def test_kept_is_what_no_rule_rejects(spark):
    texts = [*junk(), prose(10, 300), prose(11, 25), None]
    for row in judge(frame(spark, texts)).collect():
        text = Text(texts[row.doc_id] or "")
        assert row.kept == (not brute(texts[row.doc_id])[5] and not any(rule.rejects(text) for rule in RULES))
    assert sorted(r.doc_id for r in keep_good(frame(spark, texts)).collect()) == [6, 7]


def test_cascade_orders_by_rejection_per_cost():
    now = [0.0]
    spent = {"cheap": 1.0, "dear": 10.0, "never": 0.1}

    def rule(name, rejects):
        def check(text):
            now[0] += spent[name]
            return rejects

        return Rule(name, check)

    rules = (rule("never", False), rule("dear", True), rule("cheap", True))
    assert [r.name for r in cascade(rules, ["a", "b"], clock=lambda: now[0])] == ["cheap", "dear", "never"]


def test_cascade_stops_at_the_first_rejection():
    seen = []
    rules = [Rule("first", lambda t: seen.append(1) or True), Rule("second", lambda t: seen.append(2) or True)]
    assert not passes(Text("x"), rules)
    assert seen == [1]


def test_windows_are_compared_as_words(monkeypatch):
    monkeypatch.setattr(quality, "_MIXERS", quality._MIXERS * 0)  # every window gets the same key
    words = prose(12, 60).encode().split()
    assert quality.repeated_words(words) == 0
    assert quality.repeated_words(words + words[:10]) == 20


def test_empty_table_and_columns(spark):
    empty = frame(spark, [])
    assert judge(empty).count() == 0
    kept = keep_good(frame(spark, [prose(13, 40)]))
    assert kept.columns == empty.columns and kept.count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_prose_is_kept(seed):
    assert not any(rule.rejects(Text(prose(seed, 500))) for rule in RULES)
