import re

from oreworks.llm import quality_rules

TEXTS = [
    "the cat and the dog " * 3 + "of x",
    None,
    "",
    " \n\t\n",
    "a\nb\na\n \na",
    "x y z x y z x y",
    "w " * 20_000,
    " ".join(f"word{k} the" for k in range(300)),
    "### 100% $5 <tag> | & " * 30,
    "é ü 漢字 a b\x0bc",
]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    places = {}
    for k in range(len(words) - 2):
        places.setdefault(tuple(words[k : k + 3]), []).append(k)
    covered = {k + j for ks in places.values() if len(ks) > 1 for k in ks for j in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts(make):
    for r in quality_rules.apply_rules(make(TEXTS)).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute(TEXTS[r.doc_id]), r.doc_id
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.failed_rules == "")


def test_no_functions_outside_the_engine(make):
    plan = quality_rules.apply_rules(make(TEXTS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange hash" not in plan


def test_empty_table(make):
    assert quality_rules.apply_rules(make(["a"]).limit(0)).count() == 0
