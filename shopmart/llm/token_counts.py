"""Token counts under a unigram vocabulary, by dynamic programming shared along a trie.

A pre-token is a run of characters without white space, led by the vocabulary's word mark. Its
token count is that of its best segmentation: with s(p) the score of piece p,

    best(i) = max over j of best(j) + s(text[j:i])

and the count goes along. best(i) depends on the first i characters alone, so pre-tokens that begin
alike share it. The job has three steps:

1. Frequent pre-tokens, found on a small sample of texts, get their counts first: at most
   ``HEAD_WORDS`` of at most ``HEAD_CHARS`` characters, which bounds what is given to all tasks.
2. One scan of all texts sums up the counts of frequent pre-tokens and puts out the others, as
   (text's number, pre-token, times).
3. These are cut into ranges of pre-tokens and sorted. A range is a part of one trie of all such
   pre-tokens, and its order is that of a depth-first walk: going from one to the next, forward
   scores of the common beginning stay and only the rest is computed. So each trie node of a range
   is scored once, equal pre-tokens meet the count at their end, and a task holds one path. Counts
   are then summed up over the texts.

The sample steers what is shuffled and nothing else: any set of frequent pre-tokens, also none,
gives the same counts. Texts are not shuffled. Ranges go by pre-token and text, so that a frequent
pre-token which the sample missed is split; they are sampled by at most ``RANGE_CHARS`` characters
of a pre-token, so that very long ones do not burden the driver.

The vocabulary file gives pieces in order of merit but no probabilities, so piece number r has the
score -ln(r + 3), a fixed rule. A character that is no piece costs one byte piece for each of its
UTF-8 bytes, at the score of the last piece. Of equal scores the segmentation whose last piece is
longest wins.

Defined results: null and empty texts have no tokens; repeated rows and ids, also null ones, are
counted each by itself; an empty table gives no rows; only the id and text columns are read, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import log
from os.path import commonprefix

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from shopmart.llm.common import columns, pieces, slices, stored

WORD_MARK = "▁"
#: Texts of which frequent pre-tokens are taken, on average, and most such pre-tokens.
SAMPLE_ROWS = 4000
HEAD_WORDS = 1 << 17
HEAD_CHARS = 64
#: Characters of a pre-token that pick its range.
RANGE_CHARS = 128

_SCANNED = pa.schema([
    ("place", pa.int64()), ("doc_id", pa.int64()), ("n_pre_tokens", pa.int64()), ("n_tokens", pa.int64()),
    ("words", pa.list_(pa.string())), ("times", pa.list_(pa.int64())),
])
_SCANNED_SCHEMA = "place long, doc_id long, n_pre_tokens long, n_tokens long, words array<string>, times array<long>"


class Unigram:
    """Scores of pieces."""

    def __init__(self, scores: dict[str, float], unknown: float):
        self.scores, self.unknown = scores, unknown
        self.longest = max(map(len, scores), default=1)


class Walk:
    """A depth-first walk over a trie, holding the forward scores and counts of the current path."""

    def __init__(self, unigram: Unigram):
        self.unigram, self.path, self.best, self.counts, self.scored = unigram, "", [0.0], [0], 0

    def to(self, pre_token: str) -> int:
        """Tokens of a pre-token; only nodes that the path does not hold already are scored."""
        scores, longest, unknown = self.unigram.scores, self.unigram.longest, self.unigram.unknown
        best, counts, text = self.best, self.counts, WORD_MARK + pre_token
        if text == self.path:
            return counts[-1]
        shared = len(commonprefix([self.path, text]))
        del best[shared + 1 :], counts[shared + 1 :]
        for i in range(shared + 1, len(text) + 1):
            size = len(text[i - 1].encode())
            top, n = best[i - 1] + size * unknown, counts[i - 1] + size
            for j in range(i - 1, max(-1, i - 1 - longest), -1):
                score = scores.get(text[j:i])
                if score is not None and best[j] + score >= top:
                    top, n = best[j] + score, counts[j] + 1
            best.append(top)
            counts.append(n)
        self.path, self.scored = text, self.scored + len(text) - shared
        return counts[-1]


@lru_cache(maxsize=2)
def load(path: str) -> Unigram:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    usable = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return Unigram({model.id_to_piece(i): -log(i + 3) for i in usable}, -log(size + 3))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Head(dict):
    """Token counts of frequent pre-tokens; others count nothing and are noted with their number."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(counts)
        self.others: dict[str, int] = {}

    def __missing__(self, pre_token: str) -> int:
        self.others[pre_token] = self.others.get(pre_token, 0) + 1
        return 0

    def count(self, text: str) -> tuple[int, int, list[str], list[int]]:
        """Pre-tokens, tokens of the frequent ones, and the others with their number."""
        self.others, words = {}, text.split()
        tokens = sum(map(self.__getitem__, words))
        return len(words), tokens, list(self.others), list(self.others.values())


def scanned(docs: DataFrame, head: Broadcast | None = None) -> DataFrame:
    """place, doc_id, n_pre_tokens, n_tokens of frequent pre-tokens, words and times of the others.

    A long text has a row for each of its pieces, all with its place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Head(head.value if head else {})
        for rows in slices(batches):
            texts = zip(*(c.to_pylist() for c in rows.columns), strict=True)
            found = [(place, doc_id, *counts.count(piece)) for place, doc_id, text in texts for piece in pieces(text or "")]
            arrays = [pa.array(x, t.type) for x, t in zip(zip(*found, strict=True), _SCANNED, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_SCANNED)

    placed = docs.select(F.monotonically_increasing_id().alias("place"), "doc_id", "text")
    return placed.mapInArrow(run, _SCANNED_SCHEMA)


def pairs_of(rows: DataFrame) -> DataFrame:
    """place, word and times of the pre-tokens that a scan put out."""
    return rows.select("place", F.explode(F.arrays_zip("words", "times")).alias("x")).select("place", F.col("x.words").alias("word"), "x.times")


def walked(pairs: DataFrame, path: str) -> DataFrame:
    """place, word, times and the word's token count n: one walk over each range of the trie."""
    schema = pa.schema([("place", pa.int64()), ("word", pa.string()), ("times", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(load(path))
        for rows in slices(batches):
            n = [walk.to(word) for word in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(n, pa.int64())], schema=schema)

    ranges = pairs.repartitionByRange(F.substring("word", 1, RANGE_CHARS), "place").sortWithinPartitions("word")
    return ranges.mapInArrow(run, "place long, word string, times long, n long")


def head_of(texts: DataFrame, path: str) -> dict[str, int]:
    """Token counts of pre-tokens that are frequent in a sample of the texts."""
    share = min(1.0, SAMPLE_ROWS / max(1, texts.count()))
    seen = pairs_of(scanned(texts.sample(share, seed=11))).where(F.char_length("word") <= HEAD_CHARS)
    counts = seen.groupBy("word").agg(F.sum("times").alias("times")).where("times > 1")
    most = stored(counts.orderBy(F.desc("times"), "word").limit(HEAD_WORDS), "head")
    found = walked(most.select(F.lit(0).cast("long").alias("place"), "word", "times"), path)
    return {word: n for word, n in found.select("word", "n").collect()}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pre_tokens and n_tokens of every text."""
    texts = columns(docs, id_col, text_col)
    head = docs.sparkSession.sparkContext.broadcast(head_of(texts, path))
    rows = stored(scanned(texts, head), "scanned")
    rest = walked(pairs_of(rows), path).select(
        "place", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_pre_tokens"),
        (F.col("times") * F.col("n")).alias("n_tokens"),
    )
    both = rows.select("place", "doc_id", "n_pre_tokens", "n_tokens").unionByName(rest)
    sums = both.groupBy("place").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_pre_tokens").alias("n_pre_tokens"), F.sum("n_tokens").alias("n_tokens")
    )
    return sums.drop("place")
