import re
import time

from tierflow.llm.license_rules import Rule, rules
from tierflow.llm.licenses import scan

from .cases import edge_texts, frame, prose

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def brute(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        found = [k for k in range(len(words)) if words[k : k + len(parts)] == parts]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def texts():
    return edge_texts() + [
        "Released under the MIT License.",
        "MIT-LICENSE, mit  license; the ApAcHe license",
        "GNU General Public License, version 3. general public license",
        "Licensed under the Apache License, Version 2.0 é mit license",
        "émit license mité license mit licenses",
        "!!!", ".a.", "a", "license",
        "K license mit License",
        " ".join(["mit license"] * 3000) + prose(5, 300),
        "SPDX-License-Identifier: BSD-3-Clause",
        "Licensed under CC BY-NC 4.0.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ]


def test_base_columns(spark):
    cases = texts()
    rows = {r.doc_id: r for r in scan(frame(spark, cases)).collect()}
    assert len(rows) == len(cases)
    for k, text in enumerate(cases):
        r = rows[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1


def labels(spark, *cases, found_by=None):
    rows = scan(frame(spark, list(cases)), found_by).orderBy("doc_id").collect()
    return [r.labels for r in rows]


def test_versions_win_over_the_mentions_inside(spark):
    got = labels(
        spark,
        "GNU General Public License version 2 or later",
        "GNU Lesser General Public License version 2.1",
        "Mozilla Public License 2.0",
        "Mozilla Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "the three-clause? no: the BSD 3-Clause License",
        "Mit freundlichen Grüßen, the license of the apache helicopter",
    )
    assert got == ["gpl,gpl-2.0", "gpl,lgpl-2.1", "mpl-2.0", "mpl", "gpl-3.0-or-later", "bsd-3-clause", ""]


def test_suppression_by_priority_and_containment(spark):
    found_by = [
        Rule("inner", "b", 2, 0.5, "b"),
        Rule("outer", "a", 2, 0.9, "a b c"),
        Rule("weak", "a", 3, 0.2, "a b c d"),
        Rule("strong", "d", 1, 1.0, "d"),
        Rule("twin", "a", 2, 0.9, "a b c"),
    ]
    assert labels(spark, "a b c d", "b", "x", found_by=found_by) == ["outer,strong,weak", "inner", ""]


def test_rules_are_sound():
    every = rules()
    assert len(every) >= 300
    assert [r.priority for r in every] == sorted(r.priority for r in every)
    for rule in every:
        re.compile(rule.pattern)
        assert rule.keyword == rule.keyword.lower() and " " not in rule.keyword


def test_prose_has_no_label(spark):
    assert labels(spark, *(prose(k, 400) for k in range(10))) == [""] * 10
    assert scan(frame(spark, [])).count() == 0


def test_many_places_in_one_text(spark):
    text = " ".join(f"licensed under the MIT License {k}" for k in range(30_000))
    began = time.monotonic()
    row = scan(frame(spark, [text])).collect()[0]
    assert (row.n_base, row.first_word, row.base_labels) == (30_000, 3, "mit")
    assert time.monotonic() - began < 120
