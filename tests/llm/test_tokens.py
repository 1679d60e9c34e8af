import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cartlane.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
TEXTS = [
    "",
    " \t\n ",
    "Hello, world. It's 2024 and they'll say ''s 's. 'said",
    "a.b,c. d., e,. f’s «g». h.́ i,́j ́k",
    "<|startoftext|> <|STARTOFTEXT|> x<|endoftext|>. y.<|endoftext|>, <|end of text|> <|endoftext|>.",
    "İstanbul İ. ΣΑΣ ΟΔΟΣ. été. ﬁ. ǅ. K. Å",
    "x\x1cy\x85z\xa0w v　u",
    "日本語のテキスト。漢字123かな 한국어 ไทย العربية",
    "👩‍👩‍👧 🙂🙂 1️⃣ ①② ½ ٣٤",
    "\x00a\x00 ﻿b​c",
]


def whole(text):
    return len(WHOLE.encode(text, add_special_tokens=False).ids)


def test_counts_are_those_of_the_library(spark):
    rows = [(i, t, "z") for i, t in enumerate([*TEXTS, None, *TEXTS, "word " * 3000])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(df, PATH).collect()}
    for i, text, _ in rows:
        n = whole(text or "")
        assert got[i] == (len((text or "").encode()), n, n > 2048)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.count_tokens(df, PATH).collect() == []


def test_documents_by_chunks(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(df, PATH, huge=300, chunk=256, overlap=4).collect()}
    for r in df.collect():
        assert got[r.doc_id] == whole(r.text or "")


@pytest.mark.parametrize("overlap", [1, 4, 16])
def test_overlap_widens(overlap):
    for text in ("ab" * 700, "a b" * 500, "x" * 999 + " " + "y" * 999, "<|endoftext|>" * 90, "'s" * 400, "ab1" * 300, "日本語" * 300):
        assert tokens.count_huge(WHOLE, text, 64, overlap) == whole(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aeiIİΣ'stSd .,\n1٣!é́<|endoftx>日-\x1c\xa0ﬁ"), max_size=200), st.integers(1, 9), st.integers(1, 20))
def test_any_text(text, overlap, chunk):
    assert tokens.count_huge(WHOLE, text, chunk, overlap) == whole(text)
    assert tokens.Counter(PATH).count_all([text]) == [whole(text)] if len(text) % 9 == 0 else True


def test_forgets_pieces():
    counter = tokens.Counter(PATH, pieces=3)
    for text in TEXTS * 2:
        assert counter.count_all([text, text]) == [whole(text)] * 2


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tokens.Counter(public_tokenizers.path("byte_bpe_50k.json"))
