"""The license scan against plain Python."""

import re
import sys

from starloom.llm import licenses
from starloom.llm.license_rules import GATES, all_rules, gates, keywords, word_sets

RULES = all_rules()
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(text):
    words = WORD.findall(lower(text))
    starts, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    padded = " " + " ".join(words) + " "
    found = []
    if any(g in (text or "").lower() for g in GATES):
        for r in RULES:
            if f" {r.keyword} " in padded:
                found += [(m.start(), m.end(), r) for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", padded)]
    kept = []
    for a, b, r in found:
        hidden = any(
            c <= a and d >= b and e.priority >= r.priority and ((c, d) != (a, b) or e.priority > r.priority)
            for c, d, e in found
        )
        if not hidden:
            kept.append((a, b, r))
    # Of equal places with equal priority the label that sorts first counts.
    best = {}
    for a, b, r in kept:
        key = (a, b, r.priority)
        best[key] = min(best.get(key, r), r, key=lambda x: (x.label, x.confidence))
    score = max([r.confidence for r in best.values()] + [0.9] * bool(starts), default=0.0)
    every = labels | {r.label for r in best.values()}
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(labels)), ",".join(sorted(every)), score)


TEXTS = [
    "Licensed under the MIT License. MIT license, MIT-LICENSE!",
    "GNU Lesser General Public License version 2.1",
    "GNU Lesser General Public License, Version 3 or GNU General Public License v2",
    "This file is distributed under the terms of the Apache License, Version 2.0; Apache license apache license",
    "SPDX-License-Identifier: GPL-2.0-or-later",
    "Permission is hereby granted, free of charge, to any person obtaining a copy; sublicense",
    "general public license general public license",
    "mit licenseX mit\x00license é mit license",
    "Redistribution and use in source and binary forms, with or without modification, are permitted. BSD 3-Clause License",
    "Copyright (c) 2019 all rights reserved. Proprietary and confidential",
    "nothing of the kind", "", None, "mit", "MİT LICENSE mit licenſe",
    "mit license " * 3000,
]


def test_against_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.scan(df).select("doc_id", *licenses.RESULT).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_there_are_hundreds_of_rules():
    assert 300 <= len(RULES) == len(set(RULES))
    for r in RULES:
        re.compile(r.pattern)


def test_odd_rows_and_names(odd_texts, no_texts):
    got = licenses.scan(odd_texts)
    assert got.count() == odd_texts.count() and got.columns.count("score") == 1
    assert got.filter("doc_id = 2").select("n_words", "labels", "score").first() == (0, "", 0.0)
    assert licenses.scan(no_texts).count() == 0


def test_no_python_runs(odd_texts):
    plan = licenses.scan(odd_texts)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


UNGATED = [
    "Released under the GPL version 3", "distributed under MIT", "available\nunder the\nterms of the GPLv3",
    "The origin of this software must not be misrepresented", "The Software shall be used for Good, not Evil.",
    "You just DO WHAT THE FUCK YOU WANT TO.", "this is in the public\ndomain", "placed in the public-domain",
    "All advertising materials mentioning features or use of this software must display the following",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "published under new bsd",
    "neither the name of X nor the names of its contributors may be used to endorse or promote", "Published under freebsd",
    "waived all copyright and related or neighboring rights", "released under zero clause bsd", "under released gpl",
]


def test_no_match_is_lost_to_gates_or_keywords(spark, monkeypatch):
    """All rules on every text: the first word of the text as keyword, and a gate that any text passes."""
    here, want = sys.modules[__name__], {}
    rows = list(enumerate(UNGATED + [t for t in TEXTS if len(t or "") < 1000]))
    monkeypatch.setattr(here, "GATES", ("",))
    for i, t in rows:
        first = (WORD.findall(lower(t)) or ["-"])[0]
        monkeypatch.setattr(here, "RULES", [r._replace(keyword=first) for r in all_rules()])
        want[i] = brute(t)
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.scan(df).select("doc_id", *licenses.RESULT).collect()}
    assert got == want and all(want[i][5] for i in range(len(UNGATED) - 1))


def test_every_match_holds_a_keyword_and_a_gate():
    groups = gates(tuple(RULES))
    for r in RULES:
        certain = set(keywords(r))
        for words in word_sets(r.pattern):
            assert words & certain, (r, words)
            assert any(all(any(g in w for w in words) for g in group) for group in groups), (r, words)
