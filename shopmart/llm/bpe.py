"""BPE encoding and decoding by forced-boundary splitting.

A pair of neighbouring bytes that occurs inside no vocabulary token can never be merged across, so
it marks a certain cut: the merges left and right of it do not affect each other. Each word is cut
at all such pairs, the fragments are encoded independently and their ids concatenated. Only the
last fragment of a word ends in the word-end mark, so inner fragments use the same merges without
that mark.

Nothing is shuffled: texts stream through the tasks of the scan, and every worker keeps a bounded
memo of the words that it has met. A lost task is simply run again.

Defined results: a null text counts as empty; an empty text has no ids and decodes to an empty
text; repeated rows give repeated rows; an empty table gives no rows; only the id and text columns
are read, so other columns may have any name. Texts of any length are worked on in pieces cut at
white space, across which no word reaches.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from operator import add
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopmart.llm.common import columns, pieces, slices

#: Words kept by a worker; beyond twice as many the older half is let go.
MEMO_WORDS = 400_000

# Over these characters the normaliser only lower-cases, and Python's classes agree with Unicode's.
_UNUSUAL = re.compile("[^\t-\r -~À-ÖØ-öø-ÿ]")
# The vocabulary's own split pattern, written for the characters above.
_WORDS = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder(dict):
    """Maps lower-case text without white space to its ids as little-endian 32-bit bytes, on first sight."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        from tokenizers import Tokenizer, models

        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.whole = Tokenizer.from_file(path)
        self.inner = models.BPE(model["vocab"], [tuple(pair) for pair in model["merges"]])
        self.last = self.whole.model
        self.tokens = [None] * self.whole.get_vocab_size(with_added_tokens=True)
        for token, number in self.whole.get_vocab(with_added_tokens=True).items():
            self.tokens[number] = token
        self.joined = set()
        for token in model["vocab"]:
            body = token.removesuffix(self.suffix)
            self.joined.update(map("".join, zip(body, body[1:], strict=False)))
        added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec["added_tokens"]}
        self.added = added
        self.added_split = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.letters = byte_letters()
        self.memo_words, self.older = memo_words, {}

    def fragments(self, word: str) -> list[str]:
        """Cut a word of byte letters at the pairs that no token holds."""
        cuts = [0, *(i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.joined), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode_letters(self, word: str) -> bytes:
        if self.joined.issuperset(map(add, word, word[1:])):
            front, last = (), word
        else:
            *front, last = self.fragments(word)
        ids = [token.id for part in front for token in self.inner.tokenize(part)]
        ids += [token.id for token in self.last.tokenize(last)]
        return pack(f"<{len(ids)}I", *ids)

    def __missing__(self, chunk: str) -> bytes:
        """Ids of a run without white space, which may hold several words."""
        ids = self.older.get(chunk)
        if ids is None:
            words = _WORDS.findall(chunk)
            if len(words) == 1:
                letters = chunk if chunk.isascii() else "".join([self.letters[b] for b in chunk.encode()])
                ids = self.encode_letters(letters)
            else:
                ids = b"".join([self[word] for word in words])
        if len(self) >= self.memo_words:
            self.older = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def _unusual(self, text: str) -> Iterator[bytes]:
        """Normalise and split as the vocabulary's file says, then encode by fragments."""
        for part in self.added_split.split(text) if self.added_split else [text]:
            if part in self.added:
                yield self.added[part]
            elif part:
                words = self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(part))
                yield from (self.encode_letters(word) for word, _ in words)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit bytes."""
        if _UNUSUAL.search(text) or "<|" in text:
            return b"".join(self._unusual(text))
        return b"".join(map(self.__getitem__, text.lower().split()))

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary has no decoder of its own: tokens are joined by spaces."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every text: doc_id, ids array<int>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for rows in slices(batches):
            ids = [np.frombuffer(b"".join(map(bpe.encode, pieces(t or ""))), "<u4").astype("i4") for t in rows.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, ids)], dtype="i4")
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([rows.column(0), lists], ["doc_id", "ids"])

    return columns(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """Texts of id arrays: doc_id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for rows in slices(batches):
            texts = [bpe.decode(np.asarray(ids or [], "i8")) for ids in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text and keep the count of ids and both digests.

    Ids and decoded text are made and digested piece by piece, so a very long text never has them
    whole in memory.
    """

    def one(bpe: Encoder, text: str) -> tuple[int, str, str]:
        n, ids_digest, text_digest = 0, hashlib.sha256(), hashlib.sha256()
        for piece in pieces(text):
            raw = bpe.encode(piece)
            if raw:
                ids_digest.update(raw)
                decoded = bpe.decode(np.frombuffer(raw, "<u4"))
                text_digest.update((" " * bool(n) + decoded).encode())
                n += len(raw) // 4
        return n, ids_digest.hexdigest(), text_digest.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for rows in slices(batches):
            found = [one(bpe, text or "") for text in rows.column(1).to_pylist()]
            columns = [rows.column(0), *(pa.array(x, t.type) for x, t in zip(zip(*found, strict=True), list(_ARROW)[1:], strict=True))]
            yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    return columns(docs, id_col, text_col).mapInArrow(run, SCHEMA)
