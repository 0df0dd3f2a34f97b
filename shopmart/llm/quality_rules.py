"""Document quality rules as a short-circuit cascade, in DataFrame operations only.

Counts over words, lines and repeated five-word windows are made for every text by built-in array
functions; a fixed base rule looks at them. Documents that pass it go through further rules. Each of
these costs work of its own, so their order matters: on a small stored sample the job measures each
rule's cost, as the time of evaluating it over the sample, and the share that it rejects, and orders
the rules by rejected rows per second. The cascade is one CASE expression in that order, which
evaluates a rule only for rows that no earlier rule rejected. The order steers cost alone: a document
is kept if no rule rejects it, whatever the order.

Repeated windows are found in a row without comparing all pairs: window hashes are sorted together
with their positions in one array of longs, neighbours with equal hash bits are candidates, and
candidates are compared by their words. No rows are shuffled, so neither copies nor a hot source
matter.

Defined results: null and empty texts have no words and fail the base rule; repeated rows are judged
each time; an empty table gives no rows; only the id and text columns are read. Texts are read whole.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from shopmart.llm.common import columns, stored

WINDOW_WORDS = 5
LEAST_WORDS = 10
#: Rows of the sample on which cost and selectivity are measured, on average.
SAMPLE_ROWS = 1000
REPEATS = 2

_SPACE = r"[ \t-\r]+"
_BLANKS = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"

#: Rules by name: true if they reject. They see text and the counts; the values are in README.
RULES: dict[str, str] = {
    "symbol_heavy": "20 * n_symbols > word_chars",
    "repeated_lines": "n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 16 * n_words",
    "few_letters": "10 * length(regexp_replace(text, '[^\\\\p{L}]+', '')) < 5 * word_chars",
    "ellipsis_lines": "10 * regexp_count(text, '(\\\\.\\\\.\\\\.|…)[ \\\\t]*(\\\\n|$)') > 3 * n_lines",
    "bullet_lines": "10 * regexp_count(text, '(^|\\\\n)[ \\\\t]*[•*-] ') > 9 * n_lines",
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate a value once and use it in a body any number of times."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, window: int = WINDOW_WORDS) -> Column:
    """Number of words inside windows that occur twice or more in the array."""
    place_bits = 31
    size = F.size(words)

    def covered(places: Column) -> Column:
        """Words under windows that start at the given ascending places."""

        def share(place: Column, i: Column) -> Column:
            following = F.get(places, i + 1)
            return F.least(F.lit(window), F.coalesce(following - place, F.lit(window)))

        return F.aggregate(F.transform(places, share), F.lit(0), lambda total, x: total + x)

    def exact(candidates: Column) -> Column:
        """Compare candidate windows by their words."""
        texts = F.sort_array(F.transform(
            candidates, lambda at: F.struct(F.array_join(F.slice(words, at + 1, F.lit(window)), " ").alias("t"), at.alias("at"))
        ))

        def repeated(s: Column) -> Column:
            def equal(x: Column, other: Column) -> Column:
                return F.coalesce(x["t"] == other["t"], F.lit(False))

            twice = F.filter(s, lambda x, i: equal(x, F.get(s, i - 1)) | equal(x, F.get(s, i + 1)))
            return F.sort_array(F.transform(twice, lambda x: x["at"]))

        return let(let(texts, repeated), covered)

    def candidates(packed: Column) -> Column:
        """Places whose hash bits equal those of a neighbour in sorted order."""
        def equal(x: Column, other: Column) -> Column:
            return F.coalesce(F.shiftright(x, place_bits) == F.shiftright(other, place_bits), F.lit(False))

        kept = F.filter(packed, lambda x, i: equal(x, F.get(packed, i - 1)) | equal(x, F.get(packed, i + 1)))
        return F.transform(kept, lambda x: x.bitwiseAND(F.lit((1 << place_bits) - 1)).cast("int"))

    def packed(hashes: Column) -> Column:
        return F.sort_array(F.transform(
            F.sequence(F.lit(0), size - window),
            lambda i: F.shiftleft(F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]), place_bits).bitwiseOR(i.cast("long")),
        ))

    found = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: let(packed(h), lambda p: let(candidates(p), lambda c: F.when(F.size(c) == 0, 0).otherwise(exact(c)))),
    )
    return F.when(size <= window, 0).otherwise(found).cast("long")


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_row: bool = False) -> DataFrame:
    """doc_id, text and the counts that rules look at, and the whole row in ``row`` if wanted."""
    source = columns(docs, id_col, text_col)
    if whole_row:
        source = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    row = ["row"] if whole_row else []
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, _SPACE), "")
    has_word = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, _BLANKS, "")) > 0)
    numbers = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    lines = let(has_word, lambda x: F.struct(
        F.size(F.array_distinct(x)).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ))
    return source.select(
        *row,
        "doc_id",
        text.alias("text"),
        numbers.alias("w"),
        lines.alias("l"),
        F.length(F.translate(text, _BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
    ).select(*row, "doc_id", "text", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def measured_order(docs: DataFrame, rules: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """Rules by rejected rows per second on a sample of documents that pass the base rule."""
    texts = columns(docs, id_col, text_col)
    total = texts.count()
    share = min(1.0, SAMPLE_ROWS / max(1, total))
    sample = stored(counts(texts.sample(share, seed=7)).where(~base_failed()), "sample")

    def took(rule: str) -> tuple[float, int]:
        began = time.perf_counter()
        rejected = sample.agg(F.sum(F.expr(rule).cast("int"))).first()[0] or 0
        return time.perf_counter() - began, rejected

    idle = min(took("false")[0] for _ in range(REPEATS + 1))
    gain = {}
    for name, rule in rules.items():
        runs = [took(rule) for _ in range(REPEATS)]
        gain[name] = runs[0][1] / max(min(r[0] for r in runs) - idle, 1e-3)
    return sorted(rules, key=lambda name: (-gain[name], name))


def cascade(rules: dict[str, str], order: list[str]) -> Column:
    """Name of the first rule in this order that rejects a row; null if none does."""
    case = None
    for name in order:
        rejects = F.coalesce(F.expr(rules[name]), F.lit(False))
        case = F.when(rejects, name) if case is None else case.when(rejects, name)
    return case if case is not None else F.lit(None).cast("string")


def rejected_by(docs: DataFrame, rules: dict[str, str] | None, id_col: str, text_col: str) -> Column:
    """Name of the rule that rejects a row of counts, null if none; the cascade's order is measured."""
    rules = RULES if rules is None else rules
    return F.when(base_failed(), "base").otherwise(cascade(rules, measured_order(docs, rules, id_col, text_col)))


def judge(docs: DataFrame, rules: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, base_failed, kept and the rejecting rule of every document."""
    found = counts(docs, id_col, text_col).withColumns({
        "base_failed": base_failed(), "rejected_by": rejected_by(docs, rules, id_col, text_col),
    })
    return found.withColumn("kept", F.col("rejected_by").isNull()).drop("text")


def keep_good(docs: DataFrame, rules: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns unchanged, that no rule rejects."""
    # A column that is not a function of the row keeps the filter above the counts; pushed below,
    # it would work them out again at every mention.
    found = counts(docs, id_col, text_col, whole_row=True).withColumn("barrier", F.monotonically_increasing_id())
    passes = rejected_by(docs, rules, id_col, text_col).isNull() & (F.col("barrier") >= 0)
    return found.where(passes).select("row.*")
