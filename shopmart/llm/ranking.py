"""Ranked lexical search over a document FP-tree.

Terms are ranked by how many documents hold them. Each document becomes a restricted vector: the
terms of the asked items that it holds, most frequent first, with their counts. In a block of
documents, vectors that begin with the same terms share a path of a trie, so documents of one
language or topic come under one node. A node keeps, for its whole subtree, the greatest count of
each term and the least length normaliser m. Since a term's part of the score rises with its count
and falls with m, these bound the score of every document below the node.

An item is searched depth first: the best bounded child is entered first, a subtree whose bound is
below the item's k-th best score so far is left out, and what remains at the leaves is scored
exactly in integers. The k best scores of an item go on from block to block within a task.

Texts are read once, where they lie, and leave the tasks as restricted vectors. Document counts of
the terms, the number of documents and their total length come from Spark aggregates over all
documents; the driver gets no more than the asked terms' counts. Items are asked in batches bounded
in number and in terms, which is the only thing that is sent to all tasks. A task holds one block of
documents, bounded in rows, entries and tree cells, and k results for each item of the batch. What
is shuffled is k rows for each item and task.

Defined results: null texts and texts without a term have no score and do not count as documents; a
document without an id is ranked behind equal scores; repeated rows are ranked each by themselves;
an item id that occurs more than once is asked with its least text; items without an id, a text or
a term known to the documents give no rows; scores of 0 are not returned; ties go to the smaller
doc_id; empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shopmart.llm.common import SLICE_ROWS, ship, stored

K = 10
#: Items asked together, and their distinct terms together (more only for a single item).
ITEMS_AT_ONCE = 1000
TERMS_AT_ONCE = 20_000
#: A block's documents and their entries, the documents of a leaf, and the cells of a tree's table.
BLOCK_DOCS = 4096
BLOCK_ENTRIES = 1 << 20
LEAF_DOCS = 16
TREE_CELLS = 1 << 24
PIECE_BYTES = 1 << 20

#: Bytes outside ASCII letters, digits and UTF-8 sequences separate terms; only A-Z change case.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_VECTORS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])


def term_counts(text: bytes) -> Counter[bytes]:
    """How often each term occurs in a whole text, read in pieces cut between terms."""
    counts: Counter[bytes] = Counter()
    start = 0
    while start < len(text):
        piece = text[start : start + PIECE_BYTES].translate(_TERM_BYTES)
        end = len(piece)
        if start + end < len(text):
            while (cut := piece.rfind(b" ")) < 0 and start + len(piece) < len(text):
                at = start + len(piece)
                piece += text[at : at + PIECE_BYTES].translate(_TERM_BYTES)
            end = cut + 1 if cut >= 0 else len(piece)
        counts.update(piece[:end].split())
        start += end
    return counts


def restricted_vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """doc_id, length n, and terms of the vocabulary with their counts, for each text with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(start, SLICE_ROWS)
                ids, lengths, terms, counts, ends = [], [], [], [], [0]
                for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
                    found = term_counts(text.as_py() or b"")
                    if not found:
                        continue
                    held = [(vocabulary[w], c) for w, c in found.items() if w in vocabulary]
                    ids.append(doc_id)
                    lengths.append(found.total())
                    terms += [t for t, _ in held]
                    counts += [c for _, c in held]
                    ends.append(len(terms))
                offsets = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in ((terms, pa.int32()), (counts, pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *lists], schema=_VECTORS)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, terms and counts of each item with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if found := term_counts(text or b""):
                    lists = [pa.array([list(found)], pa.list_(pa.binary())), pa.array([list(found.values())], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays([pa.array([item_id], pa.int64()), *lists], names=["item_id", "terms", "counts"])

    chosen = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    chosen = chosen.where("item_id IS NOT NULL").groupBy("item_id").agg(F.min("text").cast("binary").alias("text"))
    return chosen.mapInArrow(run, "item_id long, terms array<binary>, counts array<long>")


def item_batches(rows: Iterator) -> Iterator[list[tuple[int, dict[bytes, int]]]]:
    batch, known = [], set()
    for row in rows:
        asked = dict(zip(map(bytes, row.terms), row.counts, strict=True))
        if batch and (len(batch) >= ITEMS_AT_ONCE or len(known | asked.keys()) > TERMS_AT_ONCE):
            yield batch
            batch, known = [], set()
        batch.append((row.item_id, asked))
        known |= asked.keys()
    if batch:
        yield batch


class Tree:
    """A block's documents under a trie of their restricted vectors.

    Documents lie in the order of the trie, so a node's subtree is a range of them. A node with few
    documents is a leaf; neighbouring children of few documents are one leaf together.
    """

    def __init__(self, ids: list, m: np.ndarray, terms: list[np.ndarray], counts: list[np.ndarray]):
        """terms: for each document its terms as ranks of frequency, ascending; at least one."""
        order = sorted(range(len(ids)), key=lambda i: terms[i].astype(">u4").tobytes())
        self.ids, self.m = [ids[i] for i in order], m[order]
        sequences = [terms[i] for i in order]
        self.begins = np.concatenate([[0], np.cumsum([len(x) for x in sequences])])
        self.known, self.columns = np.unique(np.concatenate(sequences), return_inverse=True)
        self.counts = np.concatenate([counts[i] for i in order])
        #: What each entry adds to a score for a weight of 1.
        self.gains = gain(self.counts, np.repeat(self.m, np.diff(self.begins)))
        shared = np.zeros(len(ids), "i8")
        for i, (a, b) in enumerate(zip(sequences[:-1], sequences[1:], strict=True), 1):
            n = min(len(a), len(b))
            differ = a[:n] != b[:n]
            shared[i] = differ.argmax() if differ.any() else n
        leaf_docs = LEAF_DOCS
        while True:
            self._grow(shared, leaf_docs)
            if len(self.ranges) * len(self.known) <= TREE_CELLS or len(self.ranges) == 1:
                break
            leaf_docs *= 2
        self._bound()

    def _grow(self, shared: np.ndarray, leaf_docs: int) -> None:
        """Nodes as ranges of documents, parents before children; shared: terms in common with the one before."""
        self.ranges: list[tuple[int, int]] = [(0, len(self.ids))]
        self.children: list[list[int]] = [[]]
        node = 0
        while node < len(self.ranges):
            a, b = self.ranges[node]
            if b - a > leaf_docs:
                inside = shared[a + 1 : b]
                cuts = [a, *(a + 1 + np.flatnonzero(inside == inside.min())).tolist(), b]
                begin = a
                for n in range(1, len(cuts)):
                    if n == len(cuts) - 1 or cuts[n + 1] - begin > leaf_docs:
                        self.children[node].append(len(self.ranges))
                        self.ranges.append((begin, cuts[n]))
                        self.children.append([])
                        begin = cuts[n]
            node += 1

    def _bound(self) -> None:
        """For each node and term, the most that the term can add in its subtree for a weight of 1."""
        leaves = [node for node, below in enumerate(self.children) if not below]
        leaf_of_doc = np.zeros(len(self.ids), "i8")
        for node in leaves:
            leaf_of_doc[slice(*self.ranges[node])] = node
        most = np.zeros((len(self.ranges), len(self.known)), "i8")
        np.maximum.at(most, (np.repeat(leaf_of_doc, np.diff(self.begins)), self.columns), self.counts)
        least_m = np.array([self.m[a:b].min() for a, b in self.ranges])
        for node in reversed(range(len(self.ranges))):
            if self.children[node]:
                most[node] = most[self.children[node]].max(axis=0)
        self.bounds = gain(most, least_m[:, None]).astype("i4")

    def search(self, ranks: np.ndarray, weights: np.ndarray, k: int, best: list[tuple]) -> list[tuple]:
        """The best k of ``best`` and this block: (-score, no id, id, score); weights of the asked ranks of terms."""
        places = np.searchsorted(self.known, ranks)
        there = places < len(self.known)
        there[there] = self.known[places[there]] == ranks[there]
        columns, weights = places[there], weights[there]
        if not len(columns):
            return best
        spread = np.zeros(len(self.known), "i8")
        spread[columns] = weights
        stack = [(0, int(self.bounds[0, columns] @ weights))]
        while stack:
            node, bound = stack.pop()
            if not bound or len(best) >= k and bound < best[-1][3]:
                continue
            if below := self.children[node]:
                reach = self.bounds[np.array(below)[:, None], columns] @ weights
                stack += [(below[i], int(reach[i])) for i in np.argsort(reach, kind="stable")]
                continue
            a, b = self.ranges[node]
            first, last = self.begins[a], self.begins[b]
            parts = spread[self.columns[first:last]] * self.gains[first:last]
            scores = np.add.reduceat(parts, self.begins[a:b] - first)
            needed = best[-1][3] if len(best) >= k else 1
            found = np.flatnonzero(scores >= needed)
            if len(found):
                better = [(-int(scores[i]), self.ids[a + i] is None, self.ids[a + i] or 0, int(scores[i])) for i in found]
                best = sorted(best + better)[:k]
        return best


def gain(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * counts // (1000 * counts + 8 * m)


def normaliser(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """A document's m; in Python integers where 64 bits might not hold the product."""
    if len(n) and 75 * int(n.max()) * documents >= 1 << 62:
        return np.array([25 + 75 * int(x) * documents // total for x in n], "i8")
    return 25 + 75 * n * documents // total


def search_vectors(
    vectors: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], rank_of: np.ndarray, documents: int, total: int, k: int
) -> DataFrame:
    """item_id, doc_id and score of the k best documents of each task for each item (id, ranks, weights)."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Tree]:
        held: list[tuple] = []
        entries = 0
        for batch in batches:
            lengths = batch.column(1).to_numpy()
            m = normaliser(lengths, documents, total)
            ends = batch.column(2).offsets.to_numpy()
            terms, counts = rank_of[batch.column(2).values.to_numpy()], batch.column(3).values.to_numpy()
            count_ends = batch.column(3).offsets.to_numpy()
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                own, much = terms[ends[i] : ends[i + 1]], counts[count_ends[i] : count_ends[i + 1]]
                if len(own):
                    order = np.argsort(own)
                    held.append((doc_id, m[i], own[order], much[order]))
                    entries += len(own)
                if len(held) >= BLOCK_DOCS or entries >= BLOCK_ENTRIES:
                    yield Tree([h[0] for h in held], np.array([h[1] for h in held]), [h[2] for h in held], [h[3] for h in held])
                    held, entries = [], 0
        if held:
            yield Tree([h[0] for h in held], np.array([h[1] for h in held]), [h[2] for h in held], [h[3] for h in held])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        for tree in blocks(batches):
            for item_id, ranks, weights in items:
                best[item_id] = tree.search(ranks, weights, k, best.get(item_id, []))
        rows = [(item_id, None if no_id else doc_id, score) for item_id, found in best.items() for _, no_id, doc_id, score in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["item_id", "doc_id", "score"])

    return vectors.mapInArrow(run, "item_id long, doc_id long, score long")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def rank(
    docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents for each item."""
    spark = docs.sparkSession
    ship(spark)
    results = [spark.createDataFrame([], "item_id long, doc_id long, score long")]
    asked_items = stored(item_terms(items, item_col, item_text_col), "items")
    for batch in item_batches(asked_items.toLocalIterator()):
        vocabulary = {w: i for i, w in enumerate(sorted({w for _, asked in batch for w in asked}))}
        vectors = stored(restricted_vectors(docs, vocabulary, id_col, text_col), "vectors")
        documents, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            continue
        # At most one row for each asked term.
        holding = dict(vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        ranked = sorted(range(len(vocabulary)), key=lambda t: (-holding.get(t, 0), t))
        rank_of = np.empty(len(vocabulary), "i8")
        rank_of[ranked] = np.arange(len(vocabulary))
        prepared = []
        for item_id, asked in batch:
            weighted = sorted((int(rank_of[vocabulary[w]]), n * weight(documents, holding.get(vocabulary[w], 0))) for w, n in asked.items())
            prepared.append((item_id, np.array([r for r, _ in weighted]), np.array([w for _, w in weighted])))
        results.append(search_vectors(vectors, prepared, rank_of, documents, total, k))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = reduce(DataFrame.unionByName, results).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")
