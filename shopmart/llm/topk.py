"""Exact top-k inner products over a bit-sliced index.

Every component of a vector is an integer, floor(scale * x). The index holds the vectors in blocks:
for each attribute the smallest value of the block is taken off, and what is left is stored as bit
slices, one bitmap over the block's rows for each binary digit.

A query's scores over a block are added up slice by slice: digit j of the query's attribute and
slice i of the index make one bitmap of weight 2^(i+j), and bitmaps of equal weight are added by
full adders (xor, and, or), whose carries have the next weight. A negative digit uses the inverted
slices, and a constant for each query makes up for it. The sum is a bit-sliced number for each row,
so the top rows are found from the most significant slice down: rows with the digit set are kept
while there are no fewer than k of them. What is left in the end are rows in front and rows with
exactly the k-th score; among these boundary rows the smallest ids win. All arithmetic is exact.

Blocks are built where the rows are read, without a shuffle. Queries travel in small batches, one
copy for each block, and each block keeps k rows a query, so what is merged in the end is k rows for
each query and block. No task holds more than one block and one batch of queries.

Any finite component takes part. Rows with a component beyond 2^26 get blocks and batches of their
own, so that their many slices burden no others. Where a block and a batch might need more than 64 bits, the same
slices are summed up and the few rows that are picked are weighed with Python's integers.

Defined results: null vectors, vectors with null or non-finite components or without an id take no
part; a score among the answers that does not fit 64 bits is an error; vectors are compared only
with vectors of the same length; a query id that occurs more than once is asked with its least vector; a query's
own id is never an answer; fewer than k rows give fewer answers; repeated rows are separate
answers; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shopmart.llm.common import ship, stored

SCALE = 1024
K = 10
BLOCK_ROWS = 8192
BATCH_QUERIES = 64
#: Rows with a greater component are kept apart.
LARGEST = 1 << 26
#: Sums that surely stay below this are made in 64 bits.
SAFE = 1 << 61
#: Bitmap words worked on at a time: rows of so many queries that the sums stay in the cache.
CHUNK_WORDS = 8192

_INDEX = pa.schema([("block", pa.int64()), ("dims", pa.int32()), ("ids", pa.binary()), ("least", pa.binary()), ("digits", pa.binary()), ("slices", pa.binary())])
_INDEX_SCHEMA = "block long, dims int, ids binary, least binary, digits binary, slices binary"


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """scale * x of every component as doubles, which tasks floor; null if the vector takes no part."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(finite, F.transform(vector, lambda x: x.cast("double") * scale))


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """Whole doubles as integers: 64-bit ones if all fit, or else Python's."""
    if not values.size or np.abs(values).max() < SAFE:
        return values.astype("i8")
    return np.array([[int(x) for x in row] for row in values.tolist()], object).reshape(values.shape)


def groups(rows: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, ids and floored vectors (as doubles) of rows (id, v), by length and apart for those with large components."""
    ids, lists = rows.column(0).to_numpy(), rows.column(1)
    lengths = np.diff(lists.offsets.to_numpy())
    flat, begins = np.floor(lists.flatten().to_numpy(zero_copy_only=False)), np.concatenate([[0], np.cumsum(lengths)[:-1]])
    for dims in np.unique(lengths):
        chosen = np.flatnonzero(lengths == dims)
        chosen = chosen[np.argsort(ids[chosen], kind="stable")]
        values = flat[begins[chosen][:, None] + np.arange(dims)] if dims else np.zeros((len(chosen), 0))
        large = (np.abs(values) > LARGEST).any(axis=1)
        for some in (~large, large):
            if some.any():
                yield int(dims), ids[chosen[some]], values[some]


def bit_slices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least value and digit count of each attribute, and slices: a bitmap of 64-bit words for each digit."""
    rows, dims = values.shape
    least = values.min(axis=0) if rows else np.zeros(dims, "i8")
    rest = values - least
    digits = np.array([int(top).bit_length() for top in (rest.max(axis=0) if dims else [])], "i8")
    words = -(-rows // 64)
    slices = np.zeros((int(digits.sum()), words * 8), "u1")
    at = 0
    for d in range(dims):
        for i in range(digits[d]):
            packed = np.packbits((rest[:, d] >> i & 1).astype("u1"), bitorder="little")
            slices[at, : len(packed)] = packed
            at += 1
    return least, digits, slices.view("<u8")


class Sum:
    """A bit-sliced number for each row: bitmaps by weight, added with full adders."""

    def __init__(self):
        self.waiting: list[list[np.ndarray]] = []

    def add(self, bitmap: np.ndarray, weight: int) -> None:
        """Add a bitmap of 2^weight; three of equal weight become a sum and a carry."""
        while True:
            while len(self.waiting) <= weight:
                self.waiting.append([])
            held = self.waiting[weight]
            if len(held) < 2:
                held.append(bitmap)
                return
            a, b = held
            half = a ^ b
            carry = a & b
            carry |= half & bitmap
            half ^= bitmap
            held[:] = [half]
            bitmap, weight = carry, weight + 1

    def slices(self) -> list[np.ndarray]:
        """Digits of the sums, least significant first."""
        digits, weight, zero = [], 0, None
        while weight < len(self.waiting):
            held = self.waiting[weight]
            if len(held) == 2:
                a, b = held
                held[:] = [a ^ b]
                self.add(a & b, weight + 1)
            zero = np.zeros_like(held[0]) if held and zero is None else zero
            digits.append(held[0] if held else None)
            weight += 1
        return [zero if d is None else d for d in digits] if zero is not None else []


def top_rows(digits: list[np.ndarray], valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows surely in front and boundary rows with the k-th score, as bitmaps for each query."""
    front, edge = np.zeros_like(valid), valid.copy()
    for bits in reversed(digits):
        higher = edge & bits
        enough = (np.bitwise_count(front | higher).sum(axis=1, dtype="i8") >= k)[:, None]
        front = np.where(enough, front, front | higher)
        edge = np.where(enough, higher, edge & ~bits)
    return front, edge


def search_block(
    ids: np.ndarray, least: np.ndarray, digits: np.ndarray, slices: np.ndarray,
    query_ids: np.ndarray, queries: np.ndarray, k: int,
) -> Iterator[tuple[int, int, int]]:
    """(query id, row id, score) of each query's best k rows of the block; ids ascend."""
    rows, words = len(ids), slices.shape[1]
    at_once = max(1, CHUNK_WORDS // max(1, words))
    everything = np.zeros(words * 8, "u1")
    full = np.packbits(np.ones(rows, "u1"), bitorder="little")
    everything[: len(full)] = full
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    spans = [1 << int(n) for n in digits]
    farthest = max((max(abs(int(x)), abs(int(x) + n)) for x, n in zip(least, spans, strict=True)), default=0)
    if farthest * max((abs(int(x)) for x in queries.ravel()), default=0) * max(1, len(digits)) >= SAFE:
        least, queries = least.astype(object), queries.astype(object)
    spans = np.array(spans, least.dtype)
    for begin in range(0, len(query_ids), at_once):
        asked, q = query_ids[begin : begin + at_once], queries[begin : begin + at_once]
        size, flip = np.abs(q), np.where((q < 0).astype(bool), ones, np.uint64(0))
        total, at = Sum(), 0
        for d, n in enumerate(digits):
            masks = [(j, np.where((size[:, d] >> j & 1).astype(bool), ones, np.uint64(0))[:, None]) for j in range(int(size[:, d].max()).bit_length())]
            masks = [(j, m) for j, m in masks if m.any()]
            for i in range(n):
                own = slices[at + i] ^ flip[:, d, None]
                for j, mask in masks:
                    total.add(own & mask, i + j)
            at += n
        # -v is the inverted slices less all their digits, so both signs differ from the sum by a constant.
        base = np.where((q < 0).astype(bool), q * (least + spans - 1), q * least).sum(axis=1)
        valid = np.repeat(everything.view("<u8")[None, :], len(asked), axis=0)
        begins, ends = np.searchsorted(ids, asked, "left"), np.searchsorted(ids, asked, "right")
        for n, (a, b) in enumerate(zip(begins, ends, strict=True)):
            for row in range(a, b):
                valid[n, row >> 6] &= ~np.uint64(1 << (row & 63))
        sums = total.slices()
        front, edge = top_rows(sums, valid, k)
        planes = np.stack(sums) if sums else np.zeros((0, *valid.shape), "<u8")
        for n, query_id in enumerate(asked):
            sure = np.flatnonzero(np.unpackbits(front[n].view("u1"), bitorder="little"))
            tied = np.flatnonzero(np.unpackbits(edge[n].view("u1"), bitorder="little"))[: max(0, k - len(sure))]
            picked = np.concatenate([sure, tied])
            bits = planes[:, n, picked >> 6] >> (picked & 63).astype("u8") & np.uint64(1)
            kind = "i8" if least.dtype != object else object
            scores = (bits.astype(kind) << np.arange(len(planes)).astype(kind)[:, None]).sum(axis=0) + base[n]
            scores = scores if kind == "i8" else np.array([int(x) for x in np.broadcast_to(scores, len(picked))], object)
            yield from zip([int(query_id)] * len(picked), ids[picked].tolist(), scores.tolist(), strict=True)


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Bit-sliced blocks of (id, v array<double>), numbered by task and place in it; least as decimal text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                for dims, ids, values in groups(batch.slice(start, block_rows)):
                    least, digits, slices = bit_slices(whole_numbers(values))
                    stored_parts = [ids.tobytes(), ",".join(map(str, least)).encode(), digits.tobytes(), slices.tobytes()]
                    row = [[number], [dims], *[[x] for x in stored_parts]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(row, _INDEX, strict=True)], schema=_INDEX)
                    number += 1

    return vectors.mapInArrow(run, _INDEX_SCHEMA)


def query_batches(queries: DataFrame, batch: int = BATCH_QUERIES) -> DataFrame:
    """Queries of equal length, ``batch`` at a time: dims, query_ids and their values as bytes."""
    schema = pa.schema([("dims", pa.int32()), ("query_ids", pa.binary()), ("queries", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for start in range(0, rows.num_rows, batch):
                for dims, ids, values in groups(rows.slice(start, batch)):
                    row = [[dims], [ids.tobytes()], [values.tobytes()]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(row, schema, strict=True)], schema=schema)

    return queries.mapInArrow(run, "dims int, query_ids binary, queries binary")


def search(
    vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for every row that ``is_query`` picks."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), scale).alias("v"), is_query.alias("asked"))
    ship(vectors.sparkSession)
    rows = rows.where("id IS NOT NULL AND v IS NOT NULL")
    index = stored(build_index(rows.select("id", "v")), "index")
    asked = rows.where("asked").groupBy("id").agg(F.min("v").alias("v"))
    batches = query_batches(asked)
    # Every batch meets every block: a copy of the small batch goes to where the block is.
    blocks = index.select("block", "dims")
    pairs = batches.join(blocks, "dims").select("block", "query_ids", "queries")
    met = index.join(pairs, "block").select("dims", "ids", "least", "digits", "slices", "query_ids", "queries")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            for n in range(batch.num_rows):
                dims, *raw = [column[n].as_py() for column in batch.columns]
                ids, digits, query_ids = (np.frombuffer(raw[i], "<i8") for i in (0, 2, 4))
                numbers = [int(x) for x in raw[1].split(b",") if x]
                least = np.array(numbers, "i8" if all(abs(x) < SAFE for x in numbers) else object)
                queries = whole_numbers(np.frombuffer(raw[5], "<f8").reshape(len(query_ids), dims))
                slices = np.frombuffer(raw[3], "<u8").reshape(int(digits.sum()), -(-len(ids) // 64))
                found = list(search_block(ids, least, digits, slices, query_ids, queries, k))
                if any(abs(score) >> 63 for *_, score in found):
                    raise ValueError("a score does not fit 64 bits")
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], schema=schema)

    best = met.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
