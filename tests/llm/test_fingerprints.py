import hashlib
import re
from collections import Counter

from tierflow.llm import fingerprints as module
from tierflow.llm.fingerprints import fingerprints

from .cases import edge_texts, frame, prose


def edited(text, following):
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def ordered(ids, texts):
    return sorted(zip(ids, [t or "" for t in texts], strict=True), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))


def check(spark, ids, texts):
    rows = ordered(ids, texts)
    want = []
    for k, (doc_id, text) in enumerate(rows):
        new = edited(text, rows[(k + 1) % len(rows)][1])
        want.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest()))
    got = fingerprints(frame(spark, texts, ids)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    return got


def test_edited_texts(spark):
    texts = edge_texts()
    check(spark, [5, 900, 3, 17, 2, 40, 41, 42, 44, 43, -7], texts)
    check(spark, [None, 1, 1, None, 2, 2, 3, 3, 3, 3, 10**12], texts)
    check(spark, [4], ["abcdefgh"])


def test_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(module.ranges, "__defaults__", (7,))
    check(spark, [k * k for k in range(120)], [prose(k, k % 30) for k in range(120)])
    check(spark, [3] * 40 + list(range(60)), [prose(k, 8) for k in range(100)])


def test_equal_texts_have_equal_fingerprints(spark):
    got = check(spark, list(range(8)), [prose(1, 40), prose(2, 40), prose(1, 40), prose(1, 40), None, "", " \n", prose(3, 9)])
    by = {r.doc_id: r for r in got}
    assert by[0].fingerprint == by[2].fingerprint == by[3].fingerprint != by[1].fingerprint
    assert by[2].near_next == 1 and by[0].near_next < 0.3
    assert by[4].fingerprint == by[5].fingerprint == by[6].fingerprint and by[4].near_next == 1


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    pairs = []
    for k in range(30):
        words = prose(k, 60).split()
        other = prose(k + 500, 60).split()
        pairs += [" ".join(words + words[:20]), " ".join(words[: 2 * k] + other[: 60 - 2 * k] + words[:20])]
    rows = {r.doc_id: r for r in fingerprints(frame(spark, pairs), samples=64).collect()}
    errors = []
    for k in range(30):
        a, b = (Counter(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in pairs[2 * k : 2 * k + 2])
        errors.append(rows[2 * k].near_next - sum((a & b).values()) / sum((a | b).values()))
    assert abs(sum(errors) / 30) < 0.02 and max(map(abs, errors)) < 0.25


def test_no_python_and_one_exchange_of_texts(spark):
    plan = fingerprints(frame(spark, [prose(k, 20) for k in range(50)]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_table(spark):
    assert fingerprints(frame(spark, [])).count() == 0
