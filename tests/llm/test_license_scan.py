import re
from itertools import product

from pyspark.sql import functions as F

from oreworks.llm import license_rules, license_scan

TEXTS = [
    "Licensed under CC BY-NC 4.0. and cc by cc by",
    "This work is licensed under the GNU General Public License, version 3.",
    "released under the MIT license. MIT License; mit licenses",
    "SPDX-License-Identifier: Apache-2.0",
    None,
    "",
    "Der Hund kam mit Lizenz",
    "Copyright (c) 2020 Foo. All rights reserved.",
    "É " * 5000 + "apache-license " * 300,
]


def base(text):
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").encode().lower().decode())
    places = []
    for label, phrase in license_rules.BASE:
        parts = phrase.split()
        places += [
            (k, label) for k in range(len(words)) if words[k : k + len(parts)] == parts
        ]
    return len(words), sorted(places)


def test_base_columns(make):
    rows = license_scan.summary(license_scan.scan(make(TEXTS))).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        n, places = base(TEXTS[r.doc_id])
        assert (r.n_words, r.n_base) == (n, len(places))
        assert r.first_word == (places[0][0] if places else None)
        assert r.last_word == (places[-1][0] if places else None)
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def brute(text, rules):
    """Detections of rules by Python's re, and those that no other one contains."""
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").lower())
    normal = " " + " ".join(words) + " "
    found = []
    for rule in rules:
        for m in re.finditer(f"(?<= )(?:{rule.regex})(?= )", normal):
            start = normal[: m.start()].count(" ") - 1
            found.append((start, start + m[0].count(" ") + 1, rule.priority, rule.label))
    found.sort(key=lambda d: (d[0], -d[1], -d[2], d[3]))
    kept = []
    for k, d in enumerate(found):
        inside = any(e[1] >= d[1] and e[2] >= d[2] for e in found[:k])
        if not inside:
            kept.append(d)
    return kept


def test_detections_are_those_of_plain_matching(make, given):
    rules = license_rules.rules()
    docs = make(TEXTS).union(given("documents").selectExpr("doc_id + 1000", "text", "lang", "source", "n_chars"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in license_scan.scan(docs).collect():
        got = [
            (d.start, d.stop, d.priority, d.label) for d in r.detections if d.priority < 9
        ]
        assert got == brute(texts[r.doc_id], rules), texts[r.doc_id]


def test_every_rule_has_its_keyword_and_passes_the_gate():
    for rule in license_rules.rules():
        assert any(x in rule.keyword + rule.regex for x in license_rules.ROOTS) or (
            rule.keyword.startswith("cc by")
        )
        re.compile(rule.regex)


def test_empty_table(make):
    assert license_scan.scan(make(["a"]).limit(0)).count() == 0


def least_matches(regex):
    """Texts of each branch of a pattern, whatever may be left out left out."""

    def made(parsed):
        parts = []
        for kind, x in parsed:
            kind = str(kind)
            if kind == "LITERAL":
                parts.append([chr(x)])
            elif kind == "BRANCH":
                parts.append([t for branch in x[1] for t in made(branch)])
            elif kind == "SUBPATTERN":
                parts.append(made(x[3]))
            elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
                parts.append([t * x[0] for t in made(x[2])] if x[0] else [""])
            elif kind == "IN":
                parts.append(["7" if str(x[0][1]) == "CATEGORY_DIGIT" else chr(x[0][1])
                              if str(x[0][0]) == "LITERAL" else "x"])
            else:
                parts.append(["x"])
        return ["".join(p) for p in product(*parts)]

    return sorted(set(made(re._parser.parse(regex))))


def test_every_match_passes_the_gate_between_any_separators(spark):
    phrases = {phrase for _, phrase in license_rules.BASE}
    for rule in license_rules.rules():
        made = least_matches(rule.regex)
        assert made and all(re.fullmatch(rule.regex, x) for x in made), rule
        phrases |= set(made)
    separators = [chr(c) for c in range(128) if not chr(c).isalnum()]
    texts = spark.createDataFrame([(p,) for p in sorted(phrases)], "p string")
    marks = spark.createDataFrame([(c,) for c in separators], "c string")
    inner = F.replace("p", F.lit(" "), F.col("c"))
    wrapped = texts.crossJoin(F.broadcast(marks)).select(
        F.explode(F.array(inner, F.concat("c", inner, "c"), F.concat(F.lit("img"), "c", inner))).alias("t")
    )
    missed = wrapped.where(~license_scan._may_match(F.col("t")))
    assert [r.t for r in missed.limit(5).collect()] == []


def test_names_between_underscores_are_found(make):
    texts = ["_CC BY 4.0_", "img_cc_by", "some MIT No Attribution text"]
    rows = license_scan.summary(license_scan.scan(make(texts))).orderBy("doc_id").collect()
    assert [r.n_base for r in rows] == [1, 1, 0]
    assert rows[0].first_word == 0 and rows[1].first_word == 1
    assert "cc-by" in rows[0].base_labels and rows[2].labels == "mit-0"
