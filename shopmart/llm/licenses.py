"""License scan by diagonal voting.

Templates and texts are sequences of words. The hashes of all rolling k-grams of all texts are
joined to the positions at which templates have them; the words themselves are compared there, so
a clash of hashes is no match. A match votes for its diagonal, the place in the text less the place
in the template: a verbatim copy puts all its votes on one diagonal, and a word left out or put in
moves the rest to a neighbouring one. Votes are counted for each text, template and diagonal,
diagonals close to each other in place are merged, and a merged span is verified: enough of the
template's k-grams must be matched, within about the template's length.

Base phrases are templates of their own, which count at every place where all their k-grams vote
for one diagonal, that is, where their words stand consecutively. Templates may be as long as whole
license texts; a span keeps the set of template places that voted for it.

The template table is constant and far below any broadcast limit, so the k-grams of the texts are
never shuffled; what matches is little. Groups are those of one text and template.

Defined results: a null text counts as empty; a text without words has no places and null first and
last words; repeated rows are told apart by their place in the scan, so ``docs`` must be a stored
table; overlapping places all count; an empty table gives no rows; only the id and text columns are
read, whole.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

GRAM_WORDS = 2
#: Share of a template's k-grams that a span must hold, and most length of a span over the template's.
LEAST_SHARE, MOST_LENGTH = 0.8, 1.3
#: Diagonals this far apart are merged if their spans touch.
NEAR = 2

# Base phrases and labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Lines by which public licenses are declared.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
}

# Whole texts of public licenses, as they stand in a license file after its copyright line.
WHOLE = {
    "mit": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
        FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS
        IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
        DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
}


def plain_words(text: str) -> str:
    """A template's words, as ``words_of`` takes them from texts, with single blanks."""
    return " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(_LOWER)))


_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


TEMPLATES |= {plain_words(text): label for label, text in WHOLE.items()}


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, _NO_WORD), "")


def template_grams(spark: SparkSession, base: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """A row for each k-gram of each template: template, its k-gram count, place and words."""
    rows = []
    for number, (phrase, label, is_base) in enumerate([*((p, x, True) for p, x in base.items()), *((p, x, False) for p, x in templates.items())]):
        words = phrase.split()
        grams = len(words) - GRAM_WORDS + 1
        if grams < 1:
            raise ValueError(f"a template needs at least {GRAM_WORDS} words: {phrase}")
        rows += [(number, label, is_base, grams, at, words[at : at + GRAM_WORDS]) for at in range(grams)]
    schema = "template int, label string, base boolean, grams int, at int, gram_words array<string>"
    hashed = F.xxhash64(*[F.col("gram_words")[k] for k in range(GRAM_WORDS)])
    return spark.createDataFrame(rows, schema).withColumn("gram", hashed)


def matches(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """Places of texts that hold a template's k-gram: row, template columns, word."""

    def gram(words: Column, i: Column) -> Column:
        parts = [F.get(words, i + k) for k in range(GRAM_WORDS)]
        return F.struct(i.alias("word"), F.xxhash64(*parts).alias("gram"), *[p.alias(f"w{k}") for k, p in enumerate(parts)])

    rolled = docs.withColumn("words", words_of(F.col("text"))).where(F.size("words") >= GRAM_WORDS).select(
        "row",
        F.explode(F.transform(F.sequence(F.lit(0), F.size("words") - GRAM_WORDS), lambda i: gram(F.col("words"), i))).alias("g"),
    ).select("row", "g.*")
    same = [rolled["gram"] == grams["gram"], *[rolled[f"w{k}"] == grams["gram_words"][k] for k in range(GRAM_WORDS)]]
    return rolled.join(F.broadcast(grams), same).select("row", "template", "label", "base", "grams", "at", "word")


def spans(docs: DataFrame, base: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """Verified spans: row, template, label, base, first word, words spanned and share of k-grams."""
    found = matches(docs, template_grams(docs.sparkSession, base, templates))
    which = ["row", "template", "label", "base", "grams"]
    diagonal = (F.col("word") - F.col("at")).alias("diagonal")
    votes = found.groupBy(*which, diagonal).agg(
        F.collect_set("at").alias("held"),
        F.min("word").alias("start"),
        (F.max("word") + GRAM_WORDS).alias("end"),
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    touches = (
        ~F.col("base")
        & (F.col("diagonal") - F.lag("diagonal").over(along) <= NEAR)
        & (F.col("start") <= F.lag("end").over(along) + NEAR)
        & (F.lag("start").over(along) <= F.col("end") + NEAR)
    )
    marked = votes.withColumn("opens", F.when(F.coalesce(touches, F.lit(False)), 0).otherwise(1))
    merged = marked.withColumn("span", F.sum("opens").over(along)).groupBy(*which, "span").agg(
        F.array_distinct(F.flatten(F.collect_list("held"))).alias("held"), F.min("start").alias("start"), F.max("end").alias("end")
    )
    # At most one entry for each place of the template.
    share = F.size("held") / F.col("grams")
    length = F.col("end") - F.col("start")
    whole = F.when(F.col("base"), share == 1).otherwise(
        (share >= LEAST_SHARE) & (length <= MOST_LENGTH * (F.col("grams") + GRAM_WORDS - 1))
    )
    return merged.where(whole).select("row", "template", "label", "base", "start", length.alias("length"), share.alias("share"))


def scan(
    docs: DataFrame, base: dict[str, str] | None = None, templates: dict[str, str] | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Words, base places, labels and score of every text."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).withColumn("row", F.monotonically_increasing_id())
    found = spans(texts, BASE if base is None else base, TEMPLATES if templates is None else templates)
    at = F.when(F.col("base"), F.col("start"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(labels)), ",")

    of_text = found.groupBy("row").agg(
        F.count(at).alias("n_base"), F.min(at).alias("first_word"), F.max(at).alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    return texts.select("row", "doc_id", F.size(words_of(F.col("text"))).cast("long").alias("n_words")).join(of_text, "row", "left").select(
        "doc_id", "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
