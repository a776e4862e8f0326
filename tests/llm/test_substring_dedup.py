import random

from oreworks.llm import substring_dedup as s


def prose(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    return " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(words))


def cleaned(docs):
    spans = {}
    for r in s.find_repeats(docs).collect():
        spans.setdefault(r.doc_id, []).append((r.first_word, r.n_words))
    return {r.doc_id: s.without_spans(r.text, spans.get(r.doc_id, [])) for r in docs.collect()}


def test_bands_are_tuned_for_recall():
    bands, rows = s.tune(0.8, 0.99, 40)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.99 and bands * rows <= 40


def test_passages_inside_paragraphs_stay_once(make):
    passage = prose(1, 90)
    texts = [f"{prose(k + 10, 30)} {passage} {prose(k + 50, 30)}" for k in range(4)]
    texts += [prose(99, 200), None, "", "one two"]
    left = cleaned(make(texts))
    middle = " ".join(passage.split()[20:70])
    assert sum(middle in (t or "") for t in left.values()) == 1
    for k in range(4):
        assert prose(k + 10, 30)[:100] in left[k]
    assert [left[k] for k in (4, 5, 6, 7)] == texts[4:]


def test_near_paragraphs_and_copies(make):
    line = prose(3, 80).replace(".", "")
    words = line.split()
    near = " ".join(words[:40] + ["changed"] + words[41:])
    far = " ".join(w if k % 4 else "other" + w for k, w in enumerate(words))
    left = cleaned(make([f"{prose(5, 30)}\n{line}", f"{prose(6, 30)}\n{near}", far, line]))
    kept = [k for k in (0, 1, 3) if len(left[k].split()) > 60]
    assert len(kept) == 1
    assert left[2] == far


def test_short_lines_are_left_alone(make):
    texts = [f"{prose(k, 40)}\nshare this page with all of your friends\n{prose(k + 30, 40)}" for k in range(6)]
    assert cleaned(make(texts)) == dict(enumerate(texts))


def test_unpunctuated_repeats_within_a_text(make):
    assert cleaned(make(["word " * 500])) == {0: "word " * 500}


def test_repeated_rows_and_empty_table(make):
    text = prose(7, 60)
    docs = make([(1, text), (1, text), (None, prose(8, 60))])
    assert [r.n_words for r in s.find_repeats(docs).collect()] == [60]
    assert s.find_repeats(docs.limit(0)).count() == 0


def plain(seed, n):
    return prose(seed, n).replace(".", "")


def test_passages_without_sentence_ends_go_whole(make):
    passage = plain(1, 60)
    texts = [f"{plain(k + 10, 30)} {passage} {plain(k + 50, 30)}" for k in range(4)]
    texts.append(f"{plain(70, 7)} {plain(1, 60)}. {plain(71, 7)}")
    found = sorted((r.first_word, r.n_words) for r in s.find_repeats(make(texts)).collect())
    # One of the documents keeps the passage; its last word has a full stop in the last text.
    assert len(found) == 4 and set(found) <= {(30, 60), (30, 59), (7, 59)}


def test_no_run_of_fifty_words_stays_in_two_documents(make, given):
    rows = [(r.doc_id, r.text) for r in given("documents").collect()]
    rng = random.Random(4)
    hard = [plain(5, 50), "a b c " * 40, prose(6, 120)]
    rows += [
        (10_000 + k, f"{plain(200 + k, rng.randint(0, 9))} {hard[k % 3]} {plain(300 + k, 8)}")
        for k in range(12)
    ]
    docs = make(rows)
    spans = {}
    for r in s.find_repeats(docs).collect():
        spans.setdefault(r.doc_id, []).append((r.first_word, r.n_words))
    holds = {}
    for r in docs.collect():
        words = (r.text or "").encode().lower().split()
        gone = [w for first, n in spans.get(r.doc_id, []) for w in range(first, first + n)]
        gone = set(gone)
        for k in range(len(words) - 49):
            if not gone & set(range(k, k + 50)):
                holds.setdefault(tuple(words[k : k + 50]), set()).add(r.doc_id)
    assert [ids for ids in holds.values() if len(ids) > 1] == []


def test_equal_paragraphs_of_short_sentences_and_lines_go(make):
    words = plain(1, 66).split()
    speech = ". ".join(" ".join(words[k : k + 3]) for k in range(0, 66, 3)) + "."
    verse = "\n".join(" ".join(w[::-1] for w in words[k : k + 3]) for k in range(0, 66, 3))
    short = ". ".join(" ".join(w * 2 for w in words[k : k + 3]) for k in range(0, 30, 3)) + "."
    lines = "\n".join(" ".join(w * 3 for w in words[k : k + 3]) for k in range(0, 30, 3))
    for passage in (speech, verse, short, lines):
        texts = [
            f"{prose(k + 10, 28)}\nx{k} y{k}\n{passage}\n{prose(k + 50, 30)}" for k in range(3)
        ]
        left = cleaned(make(texts))
        assert sorted(len(t.split()) for t in left.values()) == [
            60, 60, 60 + len(passage.split())
        ]
