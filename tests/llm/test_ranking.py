from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from text_cases import documents, empty, frame_of, prose

from shopmart.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms_of(text):
    return [re.sub("[A-Z]", lambda c: c.group().lower(), w) for w in TERM.findall(text or "")]


def plain(docs, items, k=10):
    whole = [(d, Counter(terms_of(t))) for d, t, *_ in docs]
    whole = [(d, c) for d, c in whole if c]
    n_docs, total = len(whole), sum(c.total() for _, c in whole)
    df = Counter(w for _, c in whole for w in c)
    asked = {}
    for i, t in items:
        if i is not None and t is not None:
            asked[i] = min(asked.get(i, t), t)
    found = []
    for i, t in asked.items():
        scored = []
        for d, c in whole:
            m = 25 + 75 * c.total() * n_docs // total
            parts = [
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
                for w in terms_of(t) if c[w]
            ]
            if sum(parts) > 0:
                scored.append((-sum(parts), d is None, d or 0))
        found += [(i, n, None if no_id else d, -s) for n, (s, no_id, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=str)


def search(spark, docs, items, k=10):
    frame = frame_of(spark, docs)
    return sorted(map(tuple, ranking.rank(frame, spark.createDataFrame(items, ITEMS), k).collect()), key=str)


def corpus(seed, n):
    draw = random.Random(seed)
    common = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        words = [common[min(399, int(draw.expovariate(0.02)))] for _ in range(draw.randint(1, 120))]
        text = " ".join(words)
        rows.append((i, text if i % 9 else rows[draw.randrange(i)][1] if i else text, "en", "s", None))
    return rows


def some_items(rows, seed=3, n=12):
    draw = random.Random(seed)
    items = [(i, " ".join(draw.choice(rows)[1].split()[:40])) for i in range(n)]
    return [*items, (50, "unknownterm"), (51, ""), (52, None), (None, "w1 w2"), (3, "w1 W1, w399"), (53, "w0 w0 w0")]


def test_terms():
    texts = ["", "A1 b-c_d ÉÉx　y", "İ K", "x" * 10, " . ", prose(4, 300)]
    for text in texts:
        assert {k.decode(): v for k, v in ranking.term_counts(text.encode()).items()} == Counter(terms_of(text))


def test_terms_of_a_text_in_pieces(monkeypatch):
    monkeypatch.setattr(ranking, "PIECE_BYTES", 50)
    for text in (prose(5, 400), "q" * 400 + " é" * 90, "é" * 300):
        assert {k.decode(): v for k, v in ranking.term_counts(text.encode()).items()} == Counter(terms_of(text))


@pytest.mark.parametrize(("block", "leaf", "cells"), [(4096, 16, 1 << 24), (60, 2, 1 << 24), (200, 4, 900)])
def test_equals_brute_force(spark, block, leaf, cells, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_DOCS", block)
    monkeypatch.setattr(ranking, "LEAF_DOCS", leaf)
    monkeypatch.setattr(ranking, "TREE_CELLS", cells)
    rows = corpus(block, 500)
    items = some_items(rows)
    assert search(spark, rows, items) == plain(rows, items)


def test_items_in_batches(spark, monkeypatch):
    rows = corpus(5, 120)
    items = some_items(rows)
    monkeypatch.setattr(ranking, "ITEMS_AT_ONCE", 5)
    monkeypatch.setattr(ranking, "TERMS_AT_ONCE", 60)
    assert search(spark, rows, items, 3) == plain(rows, items, 3)


def test_awkward_rows(spark):
    rows = documents()
    items = [(i, r[1]) for i, r in enumerate(rows)]
    assert search(spark, rows, items) == plain(rows, items)


def test_ties_between_many_copies(spark):
    rows = [(i, "one two three", "en", "s", None) for i in range(300, 0, -1)] + [(None, "one two three", "en", "s", None)]
    rows += [(1000 + i, "four five", "en", "s", None) for i in range(400)]
    items = [(1, "two three three"), (2, "five")]
    assert search(spark, rows, items) == plain(rows, items)


def test_empty_tables(spark):
    assert ranking.rank(empty(spark), spark.createDataFrame([(1, "a")], ITEMS)).count() == 0
    assert ranking.rank(frame_of(spark), spark.createDataFrame([], ITEMS)).count() == 0


def tree_of(rows):
    vocabulary = Counter(w for r in rows for w in set(terms_of(r[1])))
    ranks = {w: n for n, (w, _) in enumerate(sorted(vocabulary.items(), key=lambda x: (-x[1], x[0])))}
    terms, counts = [], []
    for r in rows:
        held = sorted((ranks[w], c) for w, c in Counter(terms_of(r[1])).items())
        terms.append(np.array([t for t, _ in held]))
        counts.append(np.array([c for _, c in held]))
    lengths = np.array([c.sum() for c in counts])
    return ranking.Tree([r[0] for r in rows], 25 + lengths, terms, counts), ranks


def test_bounds_cover_subtrees_and_most_leaves_are_left_out(monkeypatch):
    draw = random.Random(8)
    rows = []
    for i in range(800):  # forty topics, each with words of its own
        words = [f"t{i % 40}x{draw.randrange(30)}" if draw.random() < 0.7 else f"w{draw.randrange(50)}" for _ in range(60)]
        rows.append((i, " ".join(words)))
    tree, ranks = tree_of(rows)
    for node, (a, b) in enumerate(tree.ranges):
        first, last = tree.begins[a], tree.begins[b]
        most = np.zeros(len(tree.known), "i8")
        np.maximum.at(most, tree.columns[first:last], tree.gains[first:last])
        assert (tree.bounds[node] >= most).all()
        below = tree.children[node]
        assert not below or [tree.ranges[below[0]][0], tree.ranges[below[-1]][1]] == [a, b]
    asked = np.array(sorted(ranks[w] for w in set(terms_of(rows[30][1]))))
    weights = np.array([10 + 30 * int(r) for r in asked])
    scored = []
    reduceat = np.add.reduceat
    monkeypatch.setattr(ranking.np, "add", type("Add", (), {"reduceat": staticmethod(lambda x, at: scored.append(len(at)) or reduceat(x, at))}))
    best = tree.search(asked, weights, 3, [])
    assert len(best) == 3 and {b[2] % 40 for b in best} == {30} and sum(scored) < 400
