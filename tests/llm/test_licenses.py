from __future__ import annotations

import re
import string

import pytest
from text_cases import documents, empty, frame_of, prose

from shopmart.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_base(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        for k in range(len(words) - len(parts) + 1):
            if words[k : k + len(parts)] == parts:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def texts_of(spark, texts):
    return frame_of(spark, [(i, t, "en", "src1", None) for i, t in enumerate(texts)])


def labels_of(spark, texts):
    return {r.doc_id: r.labels for r in licenses.scan(texts_of(spark, texts)).collect()}


def test_base_places_of_awkward_rows(spark):
    found = licenses.scan(frame_of(spark))
    expected = sorted(((d, *plain_base(t)) for d, t, *_ in documents()), key=str)
    assert sorted((tuple(r)[:6] for r in found.collect()), key=str) == expected
    assert licenses.scan(empty(spark)).count() == 0


def test_base_places_in_word_and_sign_play(spark):
    texts = [
        "CC BY cc-by ccby cc by by cc by", "general public general public license", "all rights\u00e9 reserved all rights reserved",
        "cc\u00a0by", "ALL  RIGHTS...RESERVED all all rights reserved", "\u212acc by", "cc", "by cc", "general public license " * 500,
    ]
    found = {r.doc_id: tuple(r)[1:6] for r in licenses.scan(texts_of(spark, texts)).collect()}
    assert found == {i: plain_base(t) for i, t in enumerate(texts)}


def test_lines_with_words_put_in_or_left_out(spark):
    line = "This work is licensed under the GNU General Public License, version 3"
    texts = [
        prose(1) + " " + line, line.replace("licensed", "hereby licensed"), line.replace(" is ", " "),
        "This work is licensed " + prose(2) + " General Public License version 3", "Released under the MIT License.", "the MIT License",
        "Licensed, under the Apache License (Version 2.0)",
    ]
    assert labels_of(spark, texts) == {
        0: "gpl,gpl-3.0", 1: "gpl,gpl-3.0", 2: "gpl,gpl-3.0", 3: "gpl", 4: "mit", 5: "", 6: "apache-2.0",
    }


def test_whole_license_texts(spark):
    """Words left out, put in and changed; a third of the text; two licenses in one file; words in another order."""
    mit, isc = (licenses.WHOLE[n].split() for n in ("mit", "isc"))
    changed = [w for i, w in enumerate(mit) if i % 40 != 11]
    for i in range(0, len(changed), 30):
        changed.insert(i + 7, "hereby")
    texts = [
        prose(1, 300) + "\n" + " ".join(mit) + prose(2, 300), " ".join(changed), " ".join(mit[60:120]),
        " ".join(isc) + "\n\n" + " ".join(mit), " ".join(sorted(mit)), " ".join(isc).lower().replace(",", " ,\n"),
    ]
    assert labels_of(spark, texts) == {0: "mit", 1: "mit", 2: "", 3: "isc,mit", 4: "", 5: "isc"}
    docs = texts_of(spark, texts[:2]).selectExpr("doc_id AS row", "text")
    found = {r.row: r for r in licenses.spans(docs, {}, licenses.TEMPLATES).where("grams > 100").collect()}
    assert (found[0].start, found[0].length, found[0].share) == (300, len(licenses.plain_words(licenses.WHOLE["mit"]).split()), 1.0)
    assert 0.8 <= found[1].share < 1.0


def test_span_and_share(spark):
    docs = texts_of(spark, ["x y Released under the MIT License z"]).selectExpr("*", "0L AS r").drop("row").withColumnRenamed("r", "row")
    (span,) = licenses.spans(docs, licenses.BASE, licenses.TEMPLATES).where("NOT base").collect()
    assert (span.start, span.length, span.share) == (2, 5, 1.0)


def test_score_is_a_share(spark):
    scores = [r.score for r in licenses.scan(frame_of(spark)).collect()]
    assert min(scores) == 0 and max(scores) == 1


def test_template_lengths_are_checked(spark):
    with pytest.raises(ValueError):
        licenses.template_grams(spark, {"one": "x"}, {})
