from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from text_cases import documents, empty, frame_of
from tokenizers import Tokenizer

from shopmart.llm import bpe

PATH = bpe.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.encoder(PATH)


def library_row(doc_id, text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    return doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@given(st.text() | st.text("aq'zsxv é.<|>endoftext \n", max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_librarys(text):
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    ids = np.frombuffer(ENCODER.encode(text), "<u4")
    assert ids.tolist() == expected
    assert ENCODER.decode(ids) == LIBRARY.decode(expected, skip_special_tokens=False)


def test_fragments_are_cut_only_where_no_token_reaches():
    parts = ENCODER.fragments("axqzb")
    assert "".join(parts) == "axqzb" and len(parts) > 1
    assert all(a[-1] + b[0] not in ENCODER.joined for a, b in zip(parts, parts[1:], strict=False))


def test_memo_lets_old_words_go():
    small = bpe.Encoder(PATH, memo_words=3)
    words = [f"word{c}" for c in "abcdefgh"] * 2
    assert small.encode(" ".join(words)) == ENCODER.encode(" ".join(words))
    assert len(small) <= 3 and len(small.older) <= 3


def test_pieces_of_a_long_text(monkeypatch, spark):
    from shopmart.llm import common

    text = "Ärger mit   langen\n\ntexten. " * 40
    monkeypatch.setattr(common, "PIECE_CHARS", 50)
    parts = list(common.pieces(text))
    assert "".join(parts) == text and len(parts) > 5
    assert b"".join(map(ENCODER.encode, parts)) == ENCODER.encode(text)


def test_digests_of_awkward_rows(spark):
    found = bpe.digests(frame_of(spark), PATH)
    assert Counter(map(tuple, found.collect())) == Counter(library_row(r[0], r[1]) for r in documents())
    assert bpe.digests(empty(spark), PATH).count() == 0


def test_round_trip_of_the_operator(spark):
    docs = frame_of(spark)
    decoded = bpe.decode_ids(bpe.encode_ids(docs, PATH), PATH)
    expected = Counter((r[0], LIBRARY.decode(LIBRARY.encode(r[1] or "", add_special_tokens=False).ids, skip_special_tokens=False)) for r in documents())
    assert Counter(map(tuple, decoded.collect())) == expected


@pytest.mark.parametrize("word", ["qzqz", "xkjq", "éqß"])
def test_forced_cuts_change_nothing(word):
    assert np.frombuffer(ENCODER.encode(word), "<u4").tolist() == LIBRARY.encode(word, add_special_tokens=False).ids
