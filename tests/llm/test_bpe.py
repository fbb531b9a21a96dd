import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabulae.llm import bpe
from tests_llm_phrase import phrase

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    with open(PATH, encoding="utf-8") as f:
        return bpe.Codec(f.read()), library


def same(both, text):
    codec, library = both
    ids = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == ids
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(both, text):
    same(both, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|startoftext|>", "<|endoftext|>", "<|end", "'LL", "'s", " ", "\n", "ΑΣ", "é", "e\u0301", "İ", "ſ", "½",
                                 "Ⅷ", "7", "abc", "Word", "!?", "漢字", "\x1c", "\x85", "\u1c89", "\ua7ce", "\U0002ebf0"]), max_size=25).map("".join))
def test_pieces_that_are_hard(both, text):
    same(both, text)


def test_every_character_of_the_first_planes(both):
    for start in range(0, 0x30000, 256):
        same(both, "".join(f"a{chr(c)}b {chr(c)} " for c in range(start, start + 256) if not 0xD800 <= c <= 0xDFFF))


def test_long_words_and_a_small_cache(both, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    same(both, "ab" * 5000 + " " + "!" * 3000 + " " + phrase(1, 200))


def test_digests_of_rows(spark, odd, none, both):
    rows = bpe.round_trip(odd, PATH).collect()
    assert len(rows) == odd.count()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    for r in rows:
        e = both[1].encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(e), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(both[1].decode(e, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.round_trip(none, PATH).count() == 0
    ids = odd.select("doc_id", bpe.encode(spark, odd["text"], PATH).alias("ids"))
    back = ids.select("doc_id", "ids", bpe.decode(spark, ids["ids"], PATH).alias("back")).collect()
    assert all(r.back == both[1].decode(r.ids, skip_special_tokens=False) for r in back)
    assert {r.doc_id: r.n_tokens for r in bpe.tokenised(odd, PATH).collect()} == {r.doc_id: r.n_tokens for r in rows}
