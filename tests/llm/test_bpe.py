import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cartlane.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH, PATTERN, words=50)


@pytest.fixture(scope="module")
def known():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


CASES = [
    "", " ", "a\x1c\x1d b\x85 c 　 x  ", "it's I'LL we've", "aaaaaaaaaaaaaaaaaaaa" * 20, "<|endoftext|>", "\U0001f600é é",
    "ababababab " * 9, "日本語 हिन्दी ไทย\n\n ²", "".join(map(chr, [*range(0x3000), *range(0xE000, 0xF000)])),
]


def test_known_cases(codec, known):
    for text in CASES:
        ids = codec.encode_all([text])[0]
        assert ids == known.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    assert codec.encode_all(CASES) == [known.encode_ordinary(t) for t in CASES]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abth \n'é"), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=5))
def test_any_text(codec, known, texts):
    got = codec.encode_all(texts)
    assert got == [known.encode_ordinary(t) for t in texts]
    assert [codec.decode(ids) for ids in got] == [t.encode() for t in texts]


def test_documents(hard, known):
    texts = {(r["doc_id"], r["text"] or "") for r in hard.collect()}
    want = set()
    for key, text in texts:
        ids = known.encode_ordinary(text)
        want.add((key, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert {tuple(r) for r in bpe.token_digests(hard, PATH, PATTERN).collect()} == want
    encoded = bpe.encode_documents(hard, PATH, PATTERN)
    decoded = {(r["doc_id"], bytes(r["decoded"]).decode()) for r in bpe.decode_documents(encoded, PATH).collect()}
    assert decoded == texts
    assert bpe.token_digests(hard.limit(0), PATH, PATTERN).collect() == []
