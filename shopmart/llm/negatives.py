"""Hard negatives by filtering on segment summaries.

A vector's components are integers, floor(scale * x). The index holds vectors in blocks, and for
each vector it stores, at several levels, the mean and the deviation of its segments: one segment
over the whole vector at the first level, then four, then sixteen. A segment's deviation is the
root of the summed squares of what its components differ from their mean. The inner product over a
segment of length n is n * mean * mean plus at most, and minus at most, the product of both
deviations. Summed over the segments this bounds the score of two vectors from both sides.

A search refines from level to level. At each, the few most promising rows are scored exactly; rows
whose upper bound is below the k-th best of these scores, or of the lower bounds, go. What is left
after the finest level is scored exactly. Two searches follow each other:

* Positives of an anchor are its best rows of the same label.
* A positive score p sets the window ``low`` % to ``high`` % of p. Rows of other labels whose bounds
  miss every window go at once; a row that is surely inside a window and a k-th such row give the
  least score that still counts there.

Before a block's rows are looked at, the extremes of its summaries bound all its rows at once; a
block that cannot reach an anchor's least window is skipped for that anchor.

Blocks are built where the rows are read. Anchors travel in batches, one copy for each salt of the
blocks, and each block gives back at most k rows for each question, so what is merged in the end is k
rows for each question and block. Batches and blocks are shuffled once and meet in a join on salted
keys, never in a broadcast. There are at most ``MOST_SALTS`` copies, so what is shuffled grows with
the rows. A task holds the blocks of one salt, ``SALT_ROWS`` rows or a ``MOST_SALTS``-th of the index.

Bounds are made in doubles and widened by more than their rounding error. Exact scores are 64-bit
integers where they surely fit and Python integers otherwise; so every finite component takes part.

Defined results: rows without an id, a label or a vector, or with a null or non-finite component,
take no part; vectors are compared only with vectors of the same length; an anchor id that occurs
more than once is asked with its least vector and label; rows that share the anchor's id are never
its answers; repeated rows are separate answers; a positive that is repeated takes as many of the
first places but is asked once; ties go to the smaller id; an anchor without positives, or with windows that hold no row, gives no
rows; an empty table gives none. An answer whose score does not fit 64 bits is an error. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shopmart.llm.common import ship, stored

SCALE = 256
K = 10
POSITIVES = 5
#: Negatives score from so many to so many percent of the positive.
LOW, HIGH = 30, 90
#: Segments of a vector at each level.
LEVELS = (1, 4, 16)
BLOCK_ROWS = 2048
BATCH_ANCHORS = 256
#: Salts of the blocks at least and at most, and the rows of the index for each salt between the two.
SALTS, MOST_SALTS, SALT_ROWS = 64, 512, 8192
#: Rows scored exactly at each level to raise the least score that counts, for each wanted one.
TRIED = 2
#: Products of two vectors are summed in 64 bits if they surely stay below this.
SAFE = 2.0**62
#: Share of the product of both lengths by which bounds are widened for rounding.
SLACK = 1e-9

_BLOCK = "block long, dims int, ids binary, labels binary, vectors binary, means binary, deviations binary"
_BATCH = "dims int, number long, anchors binary, own_labels binary, asked binary, wanted binary"
_FOUND = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def scaled(vector: Column, scale: int) -> Column:
    """scale * x of every component, as doubles that tasks floor; null if a component is null or not finite."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.when(finite, F.transform(vector, lambda x: x.cast("double") * scale))


def segment_ends(dims: int, segments: int) -> np.ndarray:
    """Where segments of nearly equal length begin and end; no segment is empty."""
    return np.unique(np.linspace(0, dims, min(segments, dims) + 1).astype(int)) if dims else np.array([0, 0])


def summaries(vectors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Means and deviations of the segments of each vector, a matrix of (rows, segments) for each level."""
    means, deviations = [], []
    for segments in LEVELS:
        ends = segment_ends(vectors.shape[1], segments)
        mean, deviation = np.zeros((len(vectors), len(ends) - 1)), np.zeros((len(vectors), len(ends) - 1))
        for s, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            if b > a:
                mean[:, s] = vectors[:, a:b].mean(axis=1)
                deviation[:, s] = np.sqrt(np.square(vectors[:, a:b] - mean[:, s, None]).sum(axis=1))
        means.append(mean)
        deviations.append(deviation)
    return means, deviations


@dataclass
class Block:
    """Rows of the index: vectors with their summaries."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    means: list[np.ndarray]
    deviations: list[np.ndarray]

    def __post_init__(self):
        self.lengths = np.sqrt(np.square(self.vectors).sum(axis=1))
        self.widths = [np.diff(segment_ends(self.vectors.shape[1], segments)) for segments in LEVELS]
        self.largest = float(np.abs(self.vectors).max()) if self.vectors.size else 0.0

    def bounds(self, level: int, rows: np.ndarray, asked: Block, one: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that each of the rows can have with vector ``one`` of ``asked``."""
        middle = self.means[level][rows] @ (self.widths[level] * asked.means[level][one])
        spread = self.deviations[level][rows] @ asked.deviations[level][one]
        spread = spread + SLACK * self.lengths[rows] * asked.lengths[one] + 1e-3
        return middle - spread, middle + spread

    def reach(self, asked: Block) -> np.ndarray:
        """The greatest score that any row can have with each vector of ``asked``, from the extremes of the summaries."""
        level = len(LEVELS) - 1
        if not len(self.ids):
            return np.full(len(asked.ids), -np.inf)
        weights = asked.means[level] * self.widths[level]
        ends = np.maximum(weights * self.means[level].min(axis=0), weights * self.means[level].max(axis=0)).sum(axis=1)
        spread = asked.deviations[level] @ self.deviations[level].max(axis=0)
        return ends + spread + SLACK * self.lengths.max() * asked.lengths + 1e-3

    def scores(self, rows: np.ndarray, asked: Block, one: int) -> list[int]:
        """Exact inner products."""
        other = asked.vectors[one]
        if self.largest * float(np.abs(other).max(initial=0.0)) * max(1, len(other)) < SAFE:
            return (self.vectors[rows].astype("i8") @ other.astype("i8")).tolist()
        whole = [int(x) for x in other]
        return [sum(int(x) * y for x, y in zip(v, whole, strict=True)) for v in self.vectors[rows].tolist()]

    def best(self, rows: np.ndarray, asked: Block, one: int, k: int) -> list[tuple[int, int]]:
        """(score, id) of the best k of the rows, best first."""
        for level in range(len(LEVELS)):
            if len(rows) <= k:
                break
            least, most = self.bounds(level, rows, asked, one)
            tried = self.scores(rows[np.argpartition(most, -k)[-k:]], asked, one)
            needed = max(float(min(tried)) - SLACK * abs(float(min(tried))), np.partition(least, -k)[-k])
            rows = rows[~(most < needed)]
        found = zip(self.scores(rows, asked, one), self.ids[rows].tolist(), strict=True)
        return sorted(found, key=lambda x: (-x[0], x[1]))[:k]

    def best_inside(
        self, rows: np.ndarray, asked: Block, one: int, windows: list[tuple[int, int]], k: int
    ) -> list[list[tuple[int, int]]]:
        """For each window (low, high) of scores, (score, id) of the best k rows inside it."""
        limits = [(float(low), float(high)) for low, high in windows]
        for level in range(len(LEVELS)):
            if not len(rows):
                break
            least, most = self.bounds(level, rows, asked, one)
            kept = np.zeros(len(rows), bool)
            for low, high in limits:
                # A double holds the limits to within a few parts in 2^53.
                low, high = low - abs(low) * SLACK, high + abs(high) * SLACK
                sure = least[(least >= low + 2 * abs(low) * SLACK) & (most <= high - 2 * abs(high) * SLACK)]
                needed = max(low, np.partition(sure, -k)[-k]) if len(sure) >= k else low
                middle = (least + most) / 2
                likely = np.flatnonzero((middle >= needed) & (middle <= high))
                if len(likely) > TRIED * k:
                    likely = likely[np.argpartition(middle[likely], -TRIED * k)[-TRIED * k :]]
                    tried = sorted((float(x) for x in self.scores(rows[likely], asked, one)), reverse=True)
                    tried = [x for x in tried if low + 2 * abs(low) * SLACK <= x <= high - 2 * abs(high) * SLACK]
                    needed = max(needed, tried[k - 1] - abs(tried[k - 1]) * SLACK) if len(tried) >= k else needed
                kept |= ~(most < needed) & ~(least > high)
            rows = rows[kept]
        found = sorted(zip(self.scores(rows, asked, one), self.ids[rows].tolist(), strict=True), key=lambda x: (-x[0], x[1]))
        return [[x for x in found if low <= x[0] <= high][:k] for low, high in windows]


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of (id, label, v array<double>) with their summaries, numbered by task and place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                for dims, ids, labels, values in _by_length(batch.slice(start, block_rows)):
                    means, deviations = summaries(values)
                    stored_parts = [ids, labels, values, np.concatenate(means, axis=1), np.concatenate(deviations, axis=1)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number], pa.int64()), pa.array([dims], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in stored_parts]],
                        names=["block", "dims", "ids", "labels", "vectors", "means", "deviations"],
                    )
                    number += 1

    return vectors.mapInArrow(run, _BLOCK)


def _by_length(rows: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Length, ids, labels and floored vectors of the rows, for each length of vectors among them."""
    ids, labels, lists = rows.column(0).to_numpy(), rows.column(1).to_numpy(), rows.column(2)
    lengths = np.diff(lists.offsets.to_numpy())
    flat, begins = np.floor(lists.flatten().to_numpy(zero_copy_only=False)), np.concatenate([[0], np.cumsum(lengths)[:-1]])
    for dims in np.unique(lengths):
        chosen = np.flatnonzero(lengths == dims)
        values = flat[begins[chosen][:, None] + np.arange(dims)] if dims else np.zeros((len(chosen), 0))
        yield int(dims), ids[chosen].astype("i8"), labels[chosen].astype("i8"), values


def batches_of(anchors: DataFrame, rows: int = BATCH_ANCHORS) -> DataFrame:
    """Anchors (id, label, v, wanted array<struct<id, score>>) of equal length, packed ``rows`` at a time."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in arrow:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                wanted = dict(zip(part.column(0).to_pylist(), part.column(3).to_pylist(), strict=True))
                for dims, ids, labels, values in _by_length(part):
                    pairs = np.array([(i, w["id"], w["score"]) for i in ids.tolist() for w in wanted[i] or []], "i8").reshape(-1, 3)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dims], pa.int32()), pa.array([number], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in (ids, labels, values, pairs)]],
                        names=["dims", "number", "anchors", "own_labels", "asked", "wanted"],
                    )
                    number += 1

    return anchors.mapInArrow(run, _BATCH)


def _read_block(dims: int, ids: bytes, labels: bytes, vectors: bytes, means: bytes, deviations: bytes) -> Block:
    names = np.frombuffer(ids, "<i8")
    widths = [len(segment_ends(dims, segments)) - 1 for segments in LEVELS]
    cuts = np.cumsum(widths)[:-1]
    levels = [np.split(np.frombuffer(x, "<f8").reshape(len(names), sum(widths)), cuts, axis=1) for x in (means, deviations)]
    return Block(names, np.frombuffer(labels, "<i8"), np.frombuffer(vectors, "<f8").reshape(len(names), dims), *levels)


def salts_of(index: DataFrame) -> int:
    """Salts for the blocks of a stored index, from the rows in it."""
    rows = (index.agg(F.sum(F.octet_length("ids"))).first()[0] or 0) // 8
    return min(MOST_SALTS, max(SALTS, rows // SALT_ROWS))


def _met(index: DataFrame, batches: DataFrame, salts: int) -> DataFrame:
    """Every batch beside every block of vectors of its length; salts keep the one length from being one key.

    The blocks of a salt lie with a task while the batches pass by. Spark takes the copies of batches to be as
    few as the batches and would broadcast them, so the join is asked to be by sorting.
    """
    salted = batches.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    places = index.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    return salted.join(places.hint("merge"), ["dims", "salt"]).select(
        "dims", "ids", "labels", "vectors", "means", "deviations", "anchors", "own_labels", "asked", "wanted"
    )


def search_positives(block: Block, asked: Block, k: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, row, score): the best k rows of the anchor's label in the block, for each anchor."""
    for one, (anchor, label) in enumerate(zip(asked.ids.tolist(), asked.labels.tolist(), strict=True)):
        rows = np.flatnonzero((block.labels == label) & (block.ids != anchor))
        for score, row in block.best(rows, asked, one, k):
            yield anchor, row, score


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest integer from ``low`` % to ``high`` % of a score."""
    return -(-low * score // 100), high * score // 100


def search_negatives(
    block: Block, asked: Block, wanted: np.ndarray, k: int, low: int, high: int
) -> Iterator[tuple[int, int, int, int, int]]:
    """(anchor, positive, its score, row, score): the best k rows of other labels in each positive's window."""
    reach = block.reach(asked)
    for one, (anchor, label) in enumerate(zip(asked.ids.tolist(), asked.labels.tolist(), strict=True)):
        pairs = [(p, s, window_of(s, low, high)) for a, p, s in wanted[wanted[:, 0] == anchor].tolist()]
        pairs = [x for x in pairs if x[2][0] <= x[2][1]]
        if not pairs or reach[one] < float(min(x[2][0] for x in pairs)) * (1 - SLACK):
            continue
        rows = np.flatnonzero((block.labels != label) & (block.ids != anchor))
        windows = sorted({x[2] for x in pairs})
        best = dict(zip(windows, block.best_inside(rows, asked, one, windows, k), strict=True))
        for positive, positive_score, window in pairs:
            for score, row in best[window]:
                yield anchor, positive, positive_score, row, score


def _run(met: DataFrame, search) -> DataFrame:
    names = [part.split()[0] for part in _FOUND.split(", ")]

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            for n in range(batch.num_rows):
                dims, *raw = [column[n].as_py() for column in batch.columns]
                block = _read_block(dims, *raw[:5])
                vectors = np.frombuffer(raw[7], "<f8").reshape(-1, dims) if dims else np.zeros((len(raw[5]) // 8, 0))
                asked = Block(np.frombuffer(raw[5], "<i8"), np.frombuffer(raw[6], "<i8"), vectors, *summaries(vectors))
                found = list(search(block, asked, np.frombuffer(raw[8], "<i8").reshape(-1, 3)))
                if any(abs(x) >> 63 for row in found for x in (row[2], row[4])):
                    raise ValueError("a score does not fit 64 bits")
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=names)

    return met.mapInArrow(run, _FOUND)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, k: int = K, positives: int = POSITIVES,
    low: int = LOW, high: int = HIGH, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    ship(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        scaled(F.col(vector_col), scale).alias("v"), is_anchor.alias("asked"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    index = stored(build_index(rows.select("id", "label", "v")), "blocks")
    nothing = F.lit(None).cast("array<struct<id: bigint, score: bigint>>")
    asked = rows.where("asked").groupBy("id").agg(F.min(F.struct("v", "label")).alias("least"))
    asked = stored(asked.select("id", "least.label", "least.v"), "anchors")

    salts = salts_of(index)
    near = _run(_met(index, batches_of(asked.withColumn("wanted", nothing)), salts), lambda block, some, _: (
        (anchor, row, score, row, score) for anchor, row, score in search_positives(block, some, positives)
    ))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    # At most ``positives`` entries an anchor.
    wanted = near.groupBy("anchor_id").agg(F.collect_set(F.struct(F.col("vec_id").alias("id"), "score")).alias("wanted"))
    # Anchors grow with the rows, and equal vectors take far less room stored than in memory.
    questions = asked.join(wanted.hint("merge"), asked["id"] == wanted["anchor_id"]).select("id", "label", "v", "wanted")

    far = _run(_met(index, batches_of(stored(questions, "questions")), salts), lambda block, some, pairs: (
        search_negatives(block, some, pairs, k, low, high)
    ))
    order = Window.partitionBy("anchor_id", "positive_id", "positive_score").orderBy(F.desc("score"), "vec_id")
    ranked = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
