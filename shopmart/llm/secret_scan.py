r"""Secret scan over a trigram inverted index, in DataFrame operations only.

From each rule's pattern a Boolean query is derived: which trigrams a text must hold if the pattern
matches in it. The query is an OR of ANDs. ``(password|token)=`` gives (pas and ass and ... ord) or
(tok and oke and ken), for instance; ``[0-9a-f]{24,}`` gives nothing, as no trigram is mandatory.

The inverted index lists, for each trigram that some query names, the documents that hold it: rows
are numbered by their place in the scan, and a posting is a bitmap over a block of 32,768 numbers.
Trigrams are of the lower-cased text, so that one index serves patterns in any case. A rule's
candidates are found by bitmaps alone: postings of an AND's trigrams are intersected block by
block, a block that lacks one of them drops out, and the ANDs' results are united.

Candidates are then verified on their whole texts by the pattern itself, and rules without mandatory
trigrams scan all texts. The text between matches and the matches themselves, as ``split`` and
``regexp_extract_all`` give them, add up to the places of the matches in code points; the sums
are made in blocks, so their cost is linear in the number of matches.

Texts are read twice, for the index and for verification. Postings are aggregated to bitmaps before
they are shuffled. Only the table of queries, whose size depends on the rules alone, is broadcast.
Candidates are joined to the texts by number, which is a key; Spark broadcasts them itself if it has
measured them to be few, and otherwise sorts both sides by number, so that no task gets a hot key.

``docs`` must be a stored table, whose scan numbers its rows alike each time.

Defined results: a null text is the empty text, and an empty text has no spans; repeated rows and
ids, also null ones, are found each by itself; matches of one rule do not overlap, those of
different rules may; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from re import _constants as parts  # the standard library's tree of a pattern
from re import _parser as patterns

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopmart.llm.common import stored

#: Numbers in the bitmap of a block, as Spark's bitmap functions have it.
BLOCK_BITS = 32_768
#: Matches whose places are summed together.
SUM_TOGETHER = 256
#: Alternatives that a query keeps apart; beyond, it is made weaker, never wrong.
MOST_STRINGS = 64
MOST_ANDS = 64

Query = frozenset  # of ANDs; an AND is a frozenset of trigrams


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java, RE2 and Python share; a match counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


_NAMES = [either_case(w) for w in ("password", "passwd", "secret", "token")] + [f"{either_case('api')}_?{either_case('key')}"]

# Matches of the second and third rule are whole runs of their characters: a run that is too short
# from its first possible start is too short from all others, so the least length can stand in the pattern.
BASE = (
    Rule("assign", f"({'|'.join(_NAMES)})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
#: Forms that issuers of keys publish.
ADDED = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("github", "gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
)


# --- the query of a pattern -------------------------------------------------------------------


def _absorbed(ands: Iterable[frozenset[str]]) -> Query:
    """Without ANDs that ask for more than another one."""
    ands = set(ands)
    return frozenset(a for a in ands if not any(b < a for b in ands))


def _both(a: Query | None, b: Query | None) -> Query | None:
    if a is None or b is None:
        return b if a is None else a
    met = _absorbed(x | y for x in a for y in b)
    return met if len(met) <= MOST_ANDS else a


def _any_of(queries: Sequence[Query | None]) -> Query | None:
    if any(q is None for q in queries):
        return None
    met = _absorbed(a for q in queries for a in q)
    return met if len(met) <= MOST_ANDS else None


def _of_strings(strings: Iterable[str]) -> Query | None:
    """What a text must hold if it holds one of the strings; None if that is nothing."""
    ands = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
    return _any_of([frozenset([a]) if a else None for a in ands])


def _node(op, value) -> tuple[set[str] | None, Query | None]:
    """The strings that a part of a pattern can match, if they are few, or else what it asks for."""
    if op is parts.LITERAL:
        return {chr(value).lower()}, None
    if op is parts.AT:
        return {""}, None
    if op is parts.IN and all(kind is parts.LITERAL for kind, _ in value) and len(value) <= 8:
        return {chr(c).lower() for _, c in value}, None
    if op is parts.SUBPATTERN:
        return _sequence(value[-1])
    if op is parts.BRANCH:
        found = [_sequence(branch) for branch in value[1]]
        if all(strings is not None for strings, _ in found):
            return set().union(*[strings for strings, _ in found]), None
        return None, _any_of([query if strings is None else _of_strings(strings) for strings, query in found])
    if op in (parts.MAX_REPEAT, parts.MIN_REPEAT):
        least, most, inner = value
        strings, query = _sequence(inner)
        if strings is None:
            return None, query if least else None
        if (least, most) == (0, 1):
            return strings | {""}, None
        if not least or len(strings) ** min(least, 8) > MOST_STRINGS:
            return None, None
        repeated = {""}
        for _ in range(min(least, 8)):
            repeated = {r + s for r in repeated for s in strings}
        return (repeated, None) if least == most <= 8 else (None, _of_strings(repeated))
    return None, None


def _sequence(items) -> tuple[set[str] | None, Query | None]:
    run, query, whole = {""}, None, True
    for op, value in items:
        strings, asked = _node(op, value)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {r + s for r in run for s in strings}
            continue
        whole = False
        query = _both(_both(query, _of_strings(run)), asked)
        run = {""} if strings is None else strings
    return (run, None) if whole else (None, _both(query, _of_strings(run)))


def trigram_query(pattern: str) -> Query | None:
    """ORed ANDs of lower-case trigrams that every text with a match holds; None if there are none."""
    strings, query = _sequence(patterns.parse(pattern))
    return query if strings is None else _of_strings(strings)


# --- the index and its candidates -------------------------------------------------------------


def _table(spark: SparkSession, rows: list[tuple], names: Sequence[str]) -> DataFrame:
    """A small fixed table, made by the JVM alone."""
    if not rows:
        raise ValueError("a table of queries needs rows")
    made = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows])
    return spark.range(1).select(F.inline(made))


def inverted_index(placed: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """trigram, block, bits: the rows (place, text) that hold each of the trigrams, in bitmaps."""
    lowered = placed.select("place", F.lower("text").alias("lowered"))
    wanted = F.array(*[F.lit(t) for t in trigrams])
    held = lowered.select("place", F.explode(F.filter(wanted, lambda t: F.contains("lowered", t))).alias("trigram"))
    # Spark's bitmaps number from 1.
    return held.groupBy("trigram", F.bitmap_bucket_number(F.col("place") + 1).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("place") + 1)).alias("bits")
    )


def places_of(bits: Column, block: Column) -> Column:
    """The numbers whose bits are set in a block's bitmap."""

    def in_byte(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, at, F.lit(1))), 16, 10).cast("int")
        first = (block - 1) * BLOCK_BITS + (at - 1) * 8
        held = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda b: F.floor(byte / F.pow(F.lit(2), b)) % 2 == 1)
        return F.transform(held, lambda b: first + b)

    used = F.filter(F.sequence(F.lit(1), F.lit(BLOCK_BITS // 8)), lambda at: F.substring(bits, at, F.lit(1)) != F.lit(b"\x00"))
    return F.flatten(F.transform(used, in_byte))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """place and kinds: the rows that satisfy the query of each kind's rule."""
    rows = [
        (kind, n, len(trigrams), trigram)
        for kind, query in queries.items() for n, trigrams in enumerate(sorted(map(sorted, query))) for trigram in trigrams
    ]
    asked = _table(index.sparkSession, rows, ["kind", "number", "size", "trigram"])
    met = index.join(F.broadcast(asked), "trigram").groupBy("kind", "number", "size", "block").agg(
        F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n")
    )
    united = met.where("n = size").groupBy("kind", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
    found = united.select("kind", F.explode(places_of(F.col("bits"), F.col("block"))).alias("place"))
    return found.groupBy("place").agg(F.collect_set("kind").alias("kinds"))


# --- verification -----------------------------------------------------------------------------


def _matches(text: Column, rule: Rule) -> Column:
    """For each match the length of the text since the one before, its own, and whether it counts."""
    pattern = F.lit(rule.pattern)
    length = lambda x: F.coalesce(F.char_length(x), F.lit(0)).cast("long")
    joined = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
    )
    cut = F.transform(joined, lambda x: F.struct(
        length(x["gap"]).alias("gap"), length(x["found"]).alias("found"), (length(x["value"]) >= rule.least).alias("counts"),
        x["found"].isNotNull().alias("real"),
    ))
    return F.filter(cut, lambda x: x["real"])


def _block_sums(matches: Column) -> Column:
    blocks = F.sequence(F.lit(0), F.floor((F.greatest(F.size(matches), F.lit(1)) - 1) / SUM_TOGETHER).cast("int"))
    return F.transform(blocks, lambda b: F.aggregate(
        F.slice(matches, b * SUM_TOGETHER + 1, SUM_TOGETHER), F.lit(0).cast("long"), lambda s, x: s + x["gap"] + x["found"]
    ))


def _spans(matches: Column, sums: Column, kind: str, order: int) -> Column:
    """start, order, end, kind of each match that counts."""
    span = "array<struct<start: bigint, order: int, end: bigint, kind: string>>"

    def add(so_far: Column, x: Column) -> Column:
        start = so_far["at"] + x["gap"]
        one = F.struct(start.alias("start"), F.lit(order).alias("order"), (start + x["found"]).alias("end"), F.lit(kind).alias("kind"))
        return F.struct(
            (start + x["found"]).alias("at"),
            F.when(x["counts"], F.concat(so_far["spans"], F.array(one))).otherwise(so_far["spans"]).alias("spans"),
        )

    def block(total: Column, b: Column) -> Column:
        before = F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0).cast("long"), lambda s, x: s + x)
        start = F.struct(before.alias("at"), F.array().cast(span).alias("spans"))
        return F.aggregate(F.slice(matches, b * SUM_TOGETHER + 1, SUM_TOGETHER), start, add, lambda x: x["spans"])

    return F.flatten(F.transform(sums, block))


def scan(docs: DataFrame, rules: Sequence[Rule] = BASE + ADDED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (start, order, end, kind) by start and then by the order of the rules."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    asked = {kind: query for kind, query in queries.items() if query}
    placed = docs.select(
        F.monotonically_increasing_id().alias("place"), F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = placed.withColumn("kinds", F.array().cast("array<string>"))
    if asked:
        index = inverted_index(placed, sorted({t for query in asked.values() for a in query for t in a}))
        found = stored(candidates(stored(index, "postings"), asked), "candidates")
        rows = placed.join(found, "place", "left")
    nothing = F.array().cast("array<struct<gap: bigint, found: bigint, counts: boolean, real: boolean>>")
    looked = {}
    for n, rule in enumerate(rules):
        if rule.kind in asked:
            here = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        else:
            here = F.col("text").rlike(rule.pattern)
        looked[f"matches{n}"] = F.when(here, _matches(F.col("text"), rule)).otherwise(nothing)
    rows = rows.select("doc_id", *[c.alias(name) for name, c in looked.items()])
    rows = rows.select("*", *[_block_sums(F.col(f"matches{n}")).alias(f"sums{n}") for n in range(len(rules))])
    spans = [_spans(F.col(f"matches{n}"), F.col(f"sums{n}"), rule.kind, n) for n, rule in enumerate(rules)]
    return rows.select("doc_id", F.array_sort(F.concat(*spans)).alias("spans"))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, checksum of the base spans, and all spans as text."""
    base = F.filter("spans", lambda x: x["order"] < len(BASE))

    def count(n: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["order"] == n)).cast("long")

    counts = [count(n).alias(f"n_{rule.kind}") for n, rule in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
