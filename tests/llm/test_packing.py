from array import array
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.cases import no_docs, odd_docs, odd_rows

from tapeline.llm import packing
from tapeline.llm.queries import tokenizer_file

PATH = tokenizer_file()


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def whole_ids(text):
    return tokenizer().encode(text, add_special_tokens=False).ids


PARTS = [
    "don't", "It's.", "a.b", "a.,", "É", "É", "straße.", "ΣΑΣ", "İx", "<|endoftext|>", "<|X|>", "x1y", "\x1c", "\xa0", "\u0301a", "ok,", "日本", " ", "\n", "ﬁ", "ſ", "A",
    "J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "ǰ", "Øre,%%%", "word***", "word'", "'s", "ab's.", "Éoi$$$", "ŉ'", "ª", "K", "Å", "\u0340", "a\u05b0\u030c", "ᾼ", "1,2,", "--", "ño.,'",
]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12))
def test_word_by_word_ids_are_those_of_the_whole_text(parts):
    text = "".join(parts)
    got = array("H", packing.token_ids(PATH, text.encode())).tolist()
    assert got == whole_ids(text)


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("aJhTwyYKZé ÉßİŞ.,'$ " + "".join(map(chr, range(0x300, 0x370)))), max_size=20))
def test_letters_with_random_marks(text):
    assert array("H", packing.token_ids(PATH, text.encode())).tolist() == whole_ids(text)


def test_letters_whose_capitals_do_not_compose():
    for word in ("J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "H\u0331adīth"):
        assert array("H", packing.token_ids(PATH, f"x {word} y".encode())).tolist() == whole_ids(f"x {word} y")


@settings(max_examples=600, deadline=None)
@given(st.text(st.characters(min_codepoint=33, max_codepoint=0x24F), max_size=12))
def test_any_latin_text(text):
    assert array("H", packing.token_ids(PATH, text.encode())).tolist() == whole_ids(text)


def test_pieces_rebuild_every_document(spark):
    pieces = packing.pack(odd_docs(spark), PATH, window=64).toPandas()
    for _, own in pieces.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert (own.offset == own.length.cumsum() - own.length).all()
    full = pieces.groupby("sequence_id").length.sum().sort_index()
    assert (full[:-1] == 64).all() and full.iloc[-1] <= 64
    for doc_id, text, *_ in odd_rows():
        if doc_id in (None, 2):
            continue
        own = pieces[pieces.doc_id == doc_id].sort_values("start")
        ids = np.frombuffer(b"".join(own.ids), "<u4").tolist()
        assert ids == [*whole_ids(text or ""), 2] and (own.doc_tokens == len(ids)).all()
    assert (pieces[pieces.doc_id == 2].start == 0).sum() == 2  # a repeated row is packed for itself


def test_empty_table(spark):
    assert packing.pack(no_docs(spark), PATH).count() == 0


@pytest.mark.parametrize("n", [1, 3])
def test_long_words_are_not_remembered(n):
    packing.token_ids(PATH, ("q" * 100 * n).encode())
    assert ("q" * 100 * n).encode() not in packing.word_ids(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*PARTS, " ", " "]), max_size=12), max_size=5))
def test_ids_of_many_texts_are_those_of_each(parts):
    texts = ["".join(p) for p in parts]
    ids, n = packing.ids_of_texts(PATH, [t.encode() for t in texts], 2)
    got = [array("H", i).tolist() for i in ids.to_pylist()]
    assert got == [[*whole_ids(t), 2] for t in texts] and n.tolist() == [len(i) for i in got]


def test_letters_of_many_texts_are_asked_for_together_and_once():
    words, asked = packing.WordIds(PATH), []

    class Bare:
        def encode_batch_fast(self, texts, bare=words.bare, **kw):
            asked.extend(texts)
            return bare.encode_batch_fast(texts, **kw)

    words.bare, before = Bare(), packing._WORDS.get(PATH)
    packing._WORDS[PATH] = words
    try:
        text = "zyquab zyquab, Zyquab. zyquab*** quvzo. 12,"
        packing.ids_of_texts(PATH, [text.encode()] * 3, 2)
        ids, _ = packing.ids_of_texts(PATH, [text.encode()], 2)
    finally:
        packing._WORDS[PATH] = before or words
    assert [set(t.split()) for t in asked] == [{"zyquab", "quvzo"}] and b"zyquab," not in words
    assert array("H", ids[0].as_py()).tolist() == [*whole_ids(text), 2]
