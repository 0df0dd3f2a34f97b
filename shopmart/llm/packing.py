"""Order-preserving packing of documents into token sequences by dynamic programming.

The documents of a scan partition, in their order, form one stream of tokens; a sequence is a
window of that stream. Windows may be cut between documents for free, behind a sentence for a small
penalty, and elsewhere for a larger one, and the cuts are chosen so that padding plus penalties is
least. With f(j) the least cost of cutting the stream up to candidate j at position p(j),

    f(j) = min over i with p(j) - p(i) <= window of  f(i) + window - (p(j) - p(i)) + penalty(j)

The part that depends on i alone is f(i) + p(i), so a monotone queue over the sliding window gives
each minimum in constant time. A sequence whose length is a power of two needs no padding. The end
of a partition's stream, which no later document can fill up, is cut by the same program: there every
token may end a window, and a window of 2^k tokens costs its cut alone, so each place has some
transitions more. At most the last two windows of a partition, 8,192 tokens, are cut that way; a
partition of fewer tokens is cut so as a whole, behind documents and sentences where that pays.

No rows are shuffled. The stream is worked on in blocks of ``BLOCK`` tokens; the rest behind the
last full window is carried over, so memory is bounded for any partition and any text length. The
sequence number holds the partition's number in its upper bits, so a repeated task gives the same
rows.

Defined results: a null or empty text packs as its end mark alone; repeated rows are packed as
often as they occur; an empty table gives no sequences; only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from shopmart.llm import bpe
from shopmart.llm.common import columns, pieces, releasing, slices

WINDOW = 4096
END_ID = 2
#: Cost, in tokens of padding, of a cut behind a sentence and of a cut elsewhere in a document.
SENTENCE_CUT, OTHER_CUT = 4, 64
#: Tokens gathered before windows are chosen.
BLOCK = 1 << 20

_ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def choose_cuts(places: list[int], penalties: list[int], window: int, free_powers: bool = False) -> list[int]:
    """Cut positions of least padding plus penalties.

    ``places`` are the candidate positions in order, from 0 to the end of the stream and no further
    apart than ``window``; ``penalties`` their costs. With ``free_powers`` windows whose length is a
    power of two have no padding.
    """
    index = {p: i for i, p in enumerate(places)} if free_powers else {}
    lengths = [1 << k for k in range(window.bit_length()) if 1 << k <= window] if free_powers else []
    cost, back = [0] * len(places), [0] * len(places)
    queue = deque([0])  # candidates i by rising f(i) + p(i)
    value = [0] * len(places)
    for j in range(1, len(places)):
        p = places[j]
        while places[queue[0]] < p - window:
            queue.popleft()
        i = queue[0]
        total = value[i] + window - p
        for length in lengths:
            other = index.get(p - length)
            if other is not None and cost[other] < total:
                i, total = other, cost[other]
        back[j] = i
        cost[j] = total = total + penalties[j]
        value[j] = total = total + p
        while queue and value[queue[-1]] >= total:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(places) - 1
    while j:
        cuts.append(places[j])
        j = back[j]
    return cuts[::-1]


def candidates(
    n: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, window: int, step: int | None = None
) -> tuple[list[int], list[int]]:
    """Places where the stream may be cut, with their penalties; gaps longer than ``step`` get places of their own."""
    step = step or max(1, window // 8)
    marks = np.union1d(np.concatenate([doc_ends, sentence_ends]), [0, n])
    gaps = np.flatnonzero(np.diff(marks) > step)
    inner = [np.arange(marks[g] + step, marks[g + 1], step) for g in gaps]
    places = np.union1d(marks, np.concatenate(inner)) if inner else marks
    penalties = np.full(len(places), OTHER_CUT)
    penalties[np.isin(places, sentence_ends, assume_unique=False)] = SENTENCE_CUT
    penalties[np.isin(places, doc_ends, assume_unique=False)] = 0
    return places.astype(int).tolist(), penalties.tolist()


class Stream:
    """Packs the token stream of one partition and yields its pieces."""

    def __init__(self, first_sequence: int, sentence_ids: np.ndarray, window: int = WINDOW, block: int = BLOCK):
        self.window, self.block, self.sentence_ids = window, max(block, 4 * window), sentence_ids
        self.sequence, self.offset = first_sequence, 0
        self.docs: deque = deque()  # [doc_id, ids not packed yet, start, ids in all]
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        self.docs.append([doc_id, ids, 0, len(ids)])
        self.waiting += len(ids)
        found = []
        if self.waiting >= self.block:
            lengths = self._windows()
            # The last window may yet be filled by what follows.
            found = self._cut(lengths[:-1])
        return found

    def finish(self) -> list[tuple]:
        if not self.waiting:
            return []
        # The last window and the one before it are laid out anew, with all places to choose from.
        found = self._cut(self._windows()[:-2])
        return found + self._cut(self._windows(step=1, free_powers=True))

    def _windows(self, step: int | None = None, free_powers: bool = False) -> list[int]:
        ids = np.concatenate([doc[1] for doc in self.docs])
        doc_ends = np.cumsum([len(doc[1]) for doc in self.docs])
        sentence_ends = np.flatnonzero(np.isin(ids, self.sentence_ids)) + 1
        cuts = choose_cuts(*candidates(len(ids), doc_ends, sentence_ends, self.window, step), self.window, free_powers)
        return np.diff([0, *cuts]).tolist()

    def _cut(self, lengths: list[int]) -> list[tuple]:
        found = []
        for length in lengths:
            self.waiting -= length
            offset = 0
            while length:
                doc = self.docs[0]
                doc_id, ids, start, total = doc
                part = ids[:length]
                n = len(part)
                found.append((doc_id, start, n, zlib.crc32(part.tobytes()), total, self.sequence, offset))
                offset, length = offset + n, length - n
                if n == len(ids):
                    self.docs.popleft()
                else:
                    doc[1], doc[2] = ids[n:], start + n
            self.sequence += 1
        return found


def sentence_ends(encoder: bpe.Encoder) -> np.ndarray:
    """Ids of tokens that end a word with a full stop, question or exclamation mark."""
    marks = tuple(mark + encoder.suffix for mark in ".!?")
    return np.array([k for k, token in enumerate(encoder.tokens) if token and token.endswith(marks)], "<u4")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Pieces of sequences: which tokens of which document stand where."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(path)
        end = np.array([END_ID], "<u4").tobytes()
        context = TaskContext.get()
        stream = Stream((context.partitionId() if context else 0) << 40, sentence_ends(encoder), window)
        for rows in slices(batches):
            found = []
            for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                raw = b"".join([*map(encoder.encode, pieces(text or "")), end])
                found += stream.add(doc_id, np.frombuffer(raw, "<u4"))
            if found:
                yield _batch(found)
        if found := stream.finish():
            yield _batch(found)

    return columns(docs, id_col, text_col).mapInArrow(releasing(run), SCHEMA)


def _batch(found: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, pa.int64()) for column in zip(*found, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)
