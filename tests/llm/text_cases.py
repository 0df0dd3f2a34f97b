"""Small tables with the awkward rows that every text operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators also make or use themselves; they must not disturb.
CLASHING = ["score", "words", "row", "fp", "size", "bin", "place", "gram", "kept", "label"]


def prose(seed: int, words: int = 60) -> str:
    draw = random.Random(seed)
    made = ["".join(draw.choice("aeioubcdfglmnprst") for _ in range(draw.randint(2, 8))) for _ in range(words)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(made)).capitalize()


def documents():
    long_text = prose(99, 4000) + "\n" + prose(98, 4000)
    texts = [
        None, "", " \t\n\v\f\r ", "One", prose(1), prose(1), prose(1) + " more", prose(2), long_text,
        "Licensed under CC BY-NC 4.0.\n" + prose(3), "All rights reserved. All Rights Reserved, all rights\nreserved",
        "Übung   macht den MEISTER İ ΣΣ <|endoftext|> x", "same " * 300, "a b c d e a b c d e",
        "### $$$ %%% " * 20, "x" * 5000,
    ]
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"src{i % 3}", None) for i, t in enumerate(texts)]
    return [*rows, (None, prose(4), "en", "src1", 3), (7, prose(2), "en", "src1", 5), (7, prose(2), "en", "src1", 5)]


def frame_of(spark, rows=None, schema: str = SCHEMA, clashing: bool = True):
    """The rows as a stored-like frame in two partitions, with clashing extra columns."""
    df = spark.createDataFrame(documents() if rows is None else rows, schema).coalesce(2)
    for name in CLASHING if clashing else []:
        if name not in df.columns:
            df = df.selectExpr("*", f"'extra' AS `{name}`")
    return df


def empty(spark, schema: str = SCHEMA):
    return spark.createDataFrame([], schema)
