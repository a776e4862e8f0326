import public_tokenizers
import pytest
from tokenizers import Tokenizer

from oreworks.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "",
    None,
    "Don't we'LL  stop?\r\n\n\n x\t",
    "a<|endoftext|> b<|endoftext|>",
    " " * 300,
    "漢字仮名 🎉👩‍👧 ١٢٣ ²½Ⅷ \x85 　x",
    "x \n \n y  z ",
    "a" * 30_000,
    "word " * 2_000,
]


def test_counts_are_the_librarys(spark, make):
    library = Tokenizer.from_file(PATH)
    want = {
        k: len(library.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(TEXTS)
    }
    rows = token_counts.count_tokens(make(TEXTS), PATH).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == want
    assert all(r.n_bytes == len((TEXTS[r.doc_id] or "").encode()) for r in rows)
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows)


def test_given_texts(given):
    library = Tokenizer.from_file(PATH)
    docs = given("documents")
    want = {
        r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids)
        for r in docs.collect()
    }
    got = token_counts.count_tokens(docs, PATH).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want


def test_other_columns_and_empty_tables(spark, make):
    docs = make([(None, "a b"), (1, "c"), (1, "c")]).selectExpr("*", "1 AS n_tokens")
    rows = token_counts.count_tokens(docs, PATH).collect()
    assert sorted(r.n_tokens for r in rows) == [1, 1, 2]
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("piece", [b"", b"a", b" the", b"aaaa", b"\xff\xfe"])
def test_bytes_remain_where_nothing_merges(piece):
    merges = token_counts.Merges({}, [])
    assert token_counts.count_piece(piece, merges) == len(piece)
