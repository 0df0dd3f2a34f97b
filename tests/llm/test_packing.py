from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from text_cases import documents, empty, frame_of
from tokenizers import Tokenizer

from shopmart.llm import bpe, packing
from shopmart.llm.common import releasing

PATH = bpe.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)


def padding_of(length, window, free):
    return 0 if free and length & (length - 1) == 0 else window - length


def least_cost(places, penalties, window, free=False):
    best = [0] + [None] * (len(places) - 1)
    for j in range(1, len(places)):
        costs = [best[i] + padding_of(places[j] - places[i], window, free) for i in range(j) if best[i] is not None and places[j] - places[i] <= window]
        best[j] = min(costs) + penalties[j] if costs else None
    return best[-1]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_cost_least(seed):
    draw = random.Random(seed)
    window = draw.choice([5, 16, 40])
    places = [0]
    for _ in range(draw.randint(1, 60)):
        places.append(places[-1] + draw.randint(1, window))
    penalties = [draw.choice([0, 2, 9]) for _ in places]
    for free in (False, True):
        cuts = packing.choose_cuts(places, penalties, window, free)
        assert cuts[-1] == places[-1] and max(np.diff([0, *cuts])) <= window
        cost = sum(padding_of(int(d), window, free) for d in np.diff([0, *cuts])) + sum(penalties[places.index(c)] for c in cuts)
        assert cost == least_cost(places, penalties, window, free)


def test_candidates_mark_documents_sentences_and_gaps():
    places, penalties = packing.candidates(40, np.array([10, 40]), np.array([4, 10]), window=64)
    assert dict(zip(places, penalties, strict=True)) == {
        0: packing.OTHER_CUT, 4: packing.SENTENCE_CUT, 10: 0, 18: packing.OTHER_CUT, 26: packing.OTHER_CUT, 34: packing.OTHER_CUT, 40: 0,
    }


@pytest.mark.parametrize("sizes", [[1], [5], [4096], [4095, 1], [3000], [2048, 952], [100] * 29, [4000, 4000, 700], [9000, 3]])
def test_tails_are_cut_by_the_program(sizes):
    """The cost of a short stream is the least that any cuts have, and never more than that of plain powers of two."""
    stream = packing.Stream(0, np.array([], "<u4"))
    found = [p for n, size in enumerate(sizes) for p in stream.add(n, np.zeros(size, "<u4"))] + stream.finish()
    lengths = {}
    for piece in found:
        lengths[piece[5]] = lengths.get(piece[5], 0) + piece[2]
    ends = set(np.cumsum(sizes).tolist())
    cuts = np.cumsum([lengths[s] for s in sorted(lengths)]).tolist()
    cost = sum(padding_of(x, 4096, True) for x in lengths.values()) + sum(packing.OTHER_CUT for c in cuts if c not in ends)
    rest = sum(sizes) % 4096
    assert cuts[-1] == sum(sizes)
    assert cost <= packing.OTHER_CUT * (rest.bit_count() + sum(sizes) // 4096)
    if sizes == [2048, 952]:
        assert cuts[0] == 2048 and cost < packing.OTHER_CUT * 6


def check(rows, docs, window):
    """Every id in exactly one piece, sequences gapless and no longer than the window."""
    ids = defaultdict(list)
    for doc_id, text, *_ in docs:
        ids[doc_id].append(np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4"))
    sequences, covered = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        covered[r.doc_id].append(r)
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in ids[r.doc_id])
    for doc_id, copies in ids.items():
        found = sorted(p for r in covered[doc_id] for p in range(r.start, r.start + r.length))
        assert found == sorted(p for x in copies for p in range(len(x)))
    padding = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
        padding += 0 if end & (end - 1) == 0 else window - end
    return padding, sum(len(x) for copies in ids.values() for x in copies)


@pytest.mark.parametrize("window", [64, 4096])
def test_awkward_rows_are_packed(spark, window):
    rows = packing.pack(frame_of(spark), PATH, window=window).collect()
    padding, total = check(rows, documents(), window)
    assert padding < 0.05 * total or window == 64  # where cuts cost as much as a whole window
    assert packing.pack(empty(spark), PATH).count() == 0


def test_blocks_keep_the_order():
    draw = random.Random(5)
    stream = packing.Stream(7, np.array([1], "<u4"), window=16, block=64)
    docs = [(n, np.array([draw.randint(0, 3) for _ in range(draw.randint(1, 70))], "<u4")) for n in range(40)]
    found = [piece for doc in docs for piece in stream.add(*doc)] + stream.finish()
    assert [p[0] for p in found] == sorted(p[0] for p in found)
    assert sum(p[2] for p in found) == sum(len(ids) for _, ids in docs)
    assert found[0][5] == 7 and {b[5] - a[5] for a, b in zip(found, found[1:], strict=False)} <= {0, 1}


def resident():
    with open("/proc/self/status") as file:
        return next(int(line.split()[1]) for line in file if line.startswith("RssAnon")) / 1024


def test_a_task_keeps_no_freed_pages():
    """Workers stay for later tasks; what one has freed between blocks still in use goes back to the system."""
    pins = []

    def run(batches):
        blocks = [bytearray(3000) for _ in range(40_000)]
        pins.extend(blocks[:: 4000])
        yield from batches

    before = resident()
    assert list(run(iter([1, 2]))) == [1, 2]
    unreleased = resident() - before
    pins.clear()
    before = resident()
    assert list(releasing(run)(iter([1, 2]))) == [1, 2]
    assert resident() - before < 30, unreleased
