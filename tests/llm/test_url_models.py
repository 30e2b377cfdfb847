"""URL rules against plain code, models against a plain one, and accuracy on URLs that were not learnt."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tierflow.llm import url_models as u
from tierflow.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, score string, accepted string, host string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]


def ruled(url):
    host, path = parts(url)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return (best.host + best.path, best.verdict) if best else (None, None)


class Plain:
    """A variable-order model over strings, counted and smoothed by the definition."""

    def __init__(self, urls):
        self.counts = defaultdict(Counter)
        for url in urls:
            text = [*map(ord, url), u.END]
            for i, c in enumerate(text):
                for k in range(min(i, u.ORDER) + 1):
                    self.counts[tuple(text[i - k : i])][c] += 1

    def log_likelihood(self, url):
        text, total = [*map(ord, url), u.END], 0.0
        for i, c in enumerate(text):
            p = 1 / u.SYMBOLS
            for k in range(min(i, u.ORDER) + 1):
                seen = self.counts.get(tuple(text[i - k : i]))
                if seen:
                    p = (seen[c] + len(seen) * p) / (seen.total() + len(seen))
            total += math.log(p)
        return total


def urls(seed, n):
    random_ = random.Random(seed)
    sites = ["alpha", "beta", "news.gamma", "spam-farm", "cheap-pills"]
    made = []
    for _ in range(n):
        site, top = random_.choice(sites), random_.choice(["org", "com", "net"])
        lang = random_.choice(["en", "es", "fr", "de"])
        end = random_.choice(["", "/", ".html", "?page=2&ref=x", "#top"])
        made.append(f"http://www.{site}.example.{top}/{lang}/{random_.randrange(100, 9999)}{end}")
    return made


ODD = [
    None, "", "example.org/es/", "http://", "http://org", "http://org/", "HTTP://WWW.Example.ORG/es/x", "http://example.org/ES/x",
    "http://xexample.org/es/1", "http://a.example.org/en/1234?x#y", "http://example.org/en/2", "http://com/fr/", "http://a.com/fr",
    "http://a.com/fr/?q", "http://a.com?/fr/", "http://a.com#/de/", "x://y://org/", "http://org:80/", "http://ÄB.org/é", "http://a\nb.org/\n",
    "http://a.org/" + "x" * 5000, "http://a.org/\U0001f600",
]


def judged(spark, values):
    df = spark.createDataFrame([(i, v, "h", "s", "a", "h") for i, v in enumerate(values)], SCHEMA)
    return sorted((tuple(r) for r in u.judge(df, URL_RULES).collect()), key=lambda r: r[0])


def test_hosts_paths_and_rules(spark):
    values = ODD + urls(1, 200)
    got = judged(spark, values)
    assert len(got) == len(values)
    for (i, host, path, rule, verdict, score), url in zip(got, values, strict=True):
        assert (host, path) == parts(url), url
        name, said = ruled(url)
        assert rule == name, url
        assert verdict in ("allow", "block") and (said is None or verdict == said)
        assert math.isfinite(score)
    same = {v: k[5] for k, v in zip(got, values, strict=True)}
    assert all(same[v] == k[5] for k, v in zip(got, values, strict=True))


def models(spark, accepted, rejected, entries=u.MODEL_ENTRIES):
    rows = [(x, True) for x in accepted] + [(x, False) for x in rejected]
    return u.trained_filter(spark.createDataFrame(rows, "url string, accepted boolean"), entries)


def learnt(values):
    """Distinct URLs that do not calibrate."""
    import zlib

    return [x for x in sorted(set(values)) if zlib.crc32(x.encode()) % u.FOLDS != 1]


def test_scores_equal_the_plain_model(spark):
    accepted, rejected = [x for x in urls(2, 150) if ".org" in x], [x for x in urls(3, 150) if ".com" in x]
    filter_ = models(spark, accepted + accepted[:20], rejected)  # repeats are learnt once
    good, bad = Plain(learnt(accepted)), Plain(learnt(rejected))
    asked = urls(4, 30) + ["", "é😀", "x" * 3000, accepted[0]]
    got = u.log_ratios(asked, filter_.accepted, filter_.rejected)
    want = [(good.log_likelihood(x) - bad.log_likelihood(x)) / (len(x) + 1) for x in asked]
    assert np.allclose(got, want, atol=1e-9)


def test_probabilities_sum_to_one(spark):
    filter_ = models(spark, ["ab", "abc", "b"], ["ba", "c"], entries=12)  # pruned
    for model in (filter_.accepted, filter_.rejected):
        for before in ("", "a", "ab", "zz"):
            seen = [ord(c) for c in "abcz"] + [u.END]
            text = [*map(ord, before)]
            p = [
                math.exp(model.log_likelihoods(np.array([*text, c], np.uint64), np.arange(len(text) + 1))[-1])
                for c in [*seen, 5]
            ]
            assert sum(p[:-1]) + p[-1] * (u.SYMBOLS - len(seen)) == pytest.approx(1.0)


def test_learns_what_rules_stand_for(spark):
    """Spanish and German paths are blocked, others allowed; URLs of other hosts follow."""
    made = urls(5, 1500)
    good = [x for x in made if "/en/" in x or "/fr/" in x]
    bad = [x for x in made if "/es/" in x or "/de/" in x]
    filter_ = models(spark, good, bad)
    fresh = [x.replace("alpha", "zeta") for x in urls(6, 400)]
    scores = u.log_ratios(fresh, filter_.accepted, filter_.rejected)
    right = [(s >= filter_.limit) == ("/en/" in x or "/fr/" in x) for s, x in zip(scores, fresh, strict=True)]
    assert np.mean(right) > 0.95


def test_limit_takes_the_middle_of_the_widest_run():
    accepted, rejected = np.zeros(u.BINS), np.zeros(u.BINS)
    rejected[100], accepted[300] = 5, 7
    width = 2 * u.REACH / u.BINS
    assert u.best_limit(accepted, rejected) == pytest.approx((101 + 300) / 2 * width - u.REACH)


def test_without_both_classes_all_pass(spark):
    got = judged(spark, ["http://a.net/x", None, "http://b.org/"])
    assert [r[4] for r in got] == ["allow"] * 3 and [r[5] for r in got] == [0.0] * 3
    assert judged(spark, []) == []


def test_scores_beyond_what_tasks_hold_are_those_of_the_whole_models(spark):
    """With room for few entries every score, the limit and odd or repeated URLs come out as with room for all."""
    made = urls(7, 250)
    accepted, rejected = [x for x in made if ".org" in x], [x for x in made if ".com" in x]
    whole, small = models(spark, accepted, rejected), models(spark, accepted, rejected, entries=150)
    assert small.counts is not None and 0 < len(small.accepted.entries) + len(small.rejected.entries) <= 150
    assert small.limit == whole.limit
    asked = [*urls(8, 60), "", "e\u0301😀", "x" * 3000, accepted[0], accepted[0], "http://"]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(asked)], "page_id long, url string")
    got, want = ({r.page_id: r.score for r in f.with_scores(frame).collect()} for f in (small, whole))
    good, bad = Plain(learnt(accepted)), Plain(learnt(rejected))
    for i, x in enumerate(asked):
        plain = (good.log_likelihood(x) - bad.log_likelihood(x)) / (len(x) + 1)
        assert got[i] == pytest.approx(want[i], abs=1e-9) and want[i] == pytest.approx(plain, abs=1e-9), x
