"""SimHash near-duplicates found through segment popcounts.

A fingerprint's 64 bits form 32 segments of two bits; a segment's popcount is 0, 1 or 2. The
Manhattan distance of two popcount vectors never exceeds the Hamming distance of the fingerprints.
If that is at most 4, one half of the vectors (16 segments) has a distance of at most 2. So each
fingerprint goes to the grid cell of each half vector and to the cells one step away: two vectors
at distance 2 meet in the cell between them, at distance 1 in their own, at distance 0 in theirs.
The join on cells keeps a pair only if its Hamming distance is within the radius, checked exactly
inside the join, so candidates are never written.

Copies cost nothing: only distinct fingerprints are joined, and a component's documents follow by
their fingerprint. Dense groups of near copies do not turn into all their pairs either. Fingerprints
that share a half vector are first linked to one leader of that cell. Then each cell gets a few
leaders from large groups, and every fingerprint outside these groups meets them in each of its
cells. A fingerprint with many links into a group nearly always meets one, so few links are left for the join of whole cells, in which the members of the largest group of a cell are not
paired with each other. Links are kept between groups, once each, and all links that join different
groups are found, so components are exact. Joins are plain sort-merge joins, whose skewed partitions
adaptive execution splits; those on cells and half vectors ask for it, since Spark takes exploded rows
to be as few as the fingerprints and would broadcast them. Group sizes are aggregated before they are shuffled.

Components are found by spreading least labels with pointer jumping over distributed tables; each
round is written to the shared folder. Nothing but row counts reaches the driver.

Defined results: null and empty texts have fingerprint zero and are linked as any other; texts of
fewer than four words hash their whole word sequence; repeated rows and equal texts share a
component; a component whose ids are all null has a null id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shopmart.llm.common import columns, pieces, releasing, slices, stored

SEED = 42
SHINGLE_WORDS = 4
RADIUS = 4
#: A group merged by leaders counts as large in its cells from this many fingerprints on.
LARGE_GROUP = 16
#: Leaders drawn for each cell. The number steers cost only: the join of whole cells finds what is left.
DRAWS = 3
#: Rows of links in a task of a round of the component search.
ROWS_A_TASK = 50_000

_SPREAD = np.unpackbits(np.arange(256, dtype="u1")[:, None], axis=1, bitorder="little").view("<u8").ravel()
_EVEN = 0x55555555
_HALF = 0xFFFFFFFF
_ARROW = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def shingle_hashes(text: str, k: int = SHINGLE_WORDS, seed: int = SEED) -> Iterator[np.ndarray]:
    """Hashes of all k-word shingles in parts; of the whole word sequence if there are fewer words."""
    from xxhash import xxh64_intdigest as digest

    found, words = False, []
    for piece in pieces(text):
        words += piece.encode().lower().split()
        n = len(words) - k + 1
        if n <= 0:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1)
        starts = [0, *ends[: n - 1].tolist()]
        yield np.fromiter(
            (digest(joined[a:b], seed) for a, b in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)), "<u8", n
        )
        found = True
        words = words[n:]
    if words and not found:
        yield np.array([digest(b" ".join(words), seed)], "<u8")


def fingerprint(text: str, k: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Bit majority of the hashes of all k-word shingles; lower-cases A-Z only."""
    counts, shingles = np.zeros(64, "i8"), 0
    for hashes in shingle_hashes(text, k, seed):
        for at in range(0, len(hashes), 255):  # each byte of the spread sums holds one bit's count
            counts += _SPREAD[hashes[at : at + 255].view("u1").reshape(-1, 8)].sum(axis=0).view("u1")
        shingles += len(hashes)
    return int(np.packbits(2 * counts > shingles, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            found = np.array([fingerprint(text or "") for text in rows.column(1).to_pylist()], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found)], schema=_ARROW)

    return columns(docs, id_col, text_col).mapInArrow(releasing(run), "doc_id long, fp long")


def halves(fp: Column) -> Column:
    """Popcounts of the two-bit segments of each half as keys; bit 32 marks the upper half."""

    def popcounts(half: Column) -> Column:
        return half - F.shiftright(half, 1).bitwiseAND(F.lit(_EVEN))

    low, high = fp.bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned(fp, 32)
    return F.array(popcounts(low), popcounts(high) + F.lit(1 << 32))


def hamming(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def cells(nodes: DataFrame) -> DataFrame:
    """A row for each fingerprint and cell within one step of a half vector; step 0 is its own."""
    half = nodes.withColumn("half", F.explode(halves(F.col("fp"))))
    # A segment at 0 can only step up, at 2 only down, at 1 both ways.
    steps = F.expr("""
        concat(
          array(named_struct('cell', half, 'step', 0)),
          transform(
            filter(sequence(0, 30, 2), i -> (shiftright(half, i) & 3) < 2),
            i -> named_struct('cell', half + shiftleft(1L, i), 'step', 1)),
          transform(
            filter(sequence(0, 30, 2), i -> (shiftright(half, i) & 3) > 0),
            i -> named_struct('cell', half - shiftleft(1L, i), 'step', 1)))
    """)
    return half.withColumn("at", F.explode(steps)).select(*nodes.columns, "at.cell", "at.step", "half")


def leader_links(nodes: DataFrame, radius: int) -> DataFrame:
    """Links from fingerprints to the leaders of their half vectors: at most four for each."""
    keyed = nodes.select("fp", F.explode(halves(F.col("fp"))).alias("half"))
    leaders = (
        keyed.groupBy("half")
        .agg(F.min("fp").alias("least"), F.max("fp").alias("most"), F.count("*").alias("n"))
        .where("n > 1")
        .select("half", F.explode(F.array("least", "most")).alias("leader"))
    )
    near = (F.col("fp") != F.col("leader")) & (hamming("fp", "leader") <= radius)
    return keyed.join(leaders.hint("merge"), "half").where(near).select(F.col("fp").alias("a"), F.col("leader").alias("b")).distinct()


def drawn_links(groups: DataFrame, radius: int, draws: int = DRAWS) -> DataFrame:
    """Links between groups, found from fingerprints to a few leaders drawn for each cell.

    groups: fp, comp, size of the group. The leaders of a cell are members of large groups. However
    many rows a cell has, a fingerprint meets ``draws`` leaders in it at most.
    """
    lots = [F.min(F.struct(F.xxhash64("fp", F.lit(n)).alias("lot"), "fp", "comp")).alias(f"leader{n}") for n in range(draws)]
    leaders = cells(groups.where(F.col("size") >= LARGE_GROUP).select("fp", "comp")).groupBy("cell").agg(*lots)
    leaders = leaders.select("cell", F.explode(F.array_distinct(F.array(*[f"leader{n}" for n in range(draws)]))).alias("leader"))
    leaders = leaders.select("cell", F.col("leader.fp").alias("leader"), F.col("leader.comp").alias("b")).distinct()
    asked = cells(groups.select("fp", "comp")).select("cell", "fp", F.col("comp").alias("a"))
    met = asked.join(leaders.hint("merge"), "cell").where((F.col("a") != F.col("b")) & (hamming("fp", "leader") <= radius))
    return met.select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Label every node of the links (a, b) with the least node that it reaches.

    Rounds are short joins over all links, so their tables get as many partitions as the links need.
    """
    both = stored(edges.union(edges.select("b", "a")).distinct(), "links")
    parts = 1 + both.count() // ROWS_A_TASK
    both = stored(both.coalesce(parts), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")).coalesce(parts), "labels")
    while True:
        spread = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        least = labels.join(spread, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        moved = least.join(jump, "next").select("node", "label", F.least("next", "further").alias("next"))
        moved = stored(moved.coalesce(parts), "labels")
        changed = moved.where("next != label").limit(1).count()
        labels = moved.select("node", F.col("next").alias("label"))
        if not changed:
            return labels


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """fp, comp and size of the group, after links (a, b) between groups have made some of them one."""
    labels = components(links).withColumnRenamed("node", "comp")
    joined = groups.select("fp", "comp").join(labels, "comp", "left").select("fp", F.coalesce("label", "comp").alias("comp"))
    joined = stored(joined, "joined-groups")
    sizes = joined.groupBy("comp").agg(F.count("*").alias("size")).where(F.col("size") >= LARGE_GROUP)
    return stored(joined.join(sizes, "comp", "left").select("fp", "comp", F.coalesce("size", F.lit(1)).alias("size")), "groups")


def linked_groups(groups: DataFrame, radius: int) -> DataFrame:
    """All links (a, b) that are left between different groups, once each; groups: fp, comp, size."""
    all_cells = cells(groups)
    large = (
        all_cells.where(F.col("size") >= LARGE_GROUP)
        .groupBy("cell")
        .agg(F.max(F.struct("size", "comp")).alias("top"))
        .select("cell", F.col("top.comp").alias("top_comp"))
    )
    b = all_cells.select("cell", F.col("fp").alias("b"), F.col("comp").alias("comp_b"), F.col("step").alias("step_b"), F.col("half").alias("half_b"))
    a = all_cells.select("cell", F.col("fp").alias("a"), F.col("comp").alias("comp_a"), F.col("step").alias("step_a"), F.col("half").alias("half_a"))
    a = a.join(large.hint("merge"), "cell", "left").where("top_comp IS NULL OR comp_a != top_comp")
    # Two neighbours of a cell count only at distance 2: nearer pairs meet in a cell of their own.
    differ = F.col("half_a").bitwiseXOR(F.col("half_b"))
    met = (F.col("step_a") + F.col("step_b") < 2) | (differ != 0)
    once = (F.col("a") < F.col("b")) | (F.col("comp_b") == F.col("top_comp"))
    wanted = met & once & (F.col("comp_a") != F.col("comp_b")) & (hamming("a", "b") <= radius)
    left, right = a.alias("l"), b.alias("r").hint("merge")
    pairs = left.join(right, (F.col("l.cell") == F.col("r.cell")) & wanted)
    return pairs.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fp and component_id, the least id that can be reached over links."""
    if not 0 <= radius <= 4:
        raise ValueError("the cells of half vectors find links of at most 4 differing bits")
    marked = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    groups = merged(nodes.select("fp", F.col("fp").alias("comp")), leader_links(nodes, radius))
    drawn = stored(drawn_links(groups, radius), "drawn")
    if drawn.limit(1).count():
        groups = merged(groups, drawn)
    groups = merged(groups, stored(linked_groups(groups, radius), "linked"))
    # Stored, so that the join below is of plain tables and a large component's partition can be split.
    ids = stored(groups.join(nodes, "fp").groupBy("comp").agg(F.min("least_id").alias("component_id")), "ids")
    return marked.join(groups.join(ids, "comp").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def thinned(docs: DataFrame, id_col: str, find: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """One row of ``docs`` for each component that ``find`` gives to rows numbered in a column."""
    place = "row_of_scan"
    while place in docs.columns:
        place += "_"
    placed = docs.withColumn(place, F.monotonically_increasing_id())
    groups = find(placed, place).select(F.col("doc_id").alias(place), F.col("component_id").alias("group"))
    ids = placed.select(place, F.col(id_col).alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("missing"), F.col("id"), F.col(place).alias("place")))
    kept = groups.join(ids, place).groupBy("group").agg(first.alias("first")).select(F.col("first.place").alias(place))
    return placed.join(kept, place, "left_semi").drop(place)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component, all columns unchanged: the one with the least id.

    ``docs`` must be a stored table: rows are told apart by their place in its scan, which is the
    same each time, so null and repeated ids do no harm.
    """
    return thinned(docs, id_col, lambda placed, place: near_duplicates(placed, place, text_col, radius))
