from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from text_cases import documents, empty, frame_of, prose

from shopmart.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often = Counter(windows)
    covered = {p for k, w in enumerate(windows) if often[w] > 1 for p in range(k, k + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def counts_of(df):
    return [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect()]


def repetitive(seed):
    draw = random.Random(seed)
    return "".join(draw.choice("abc") + draw.choice([" ", "  ", "\n", "\t"]) for _ in range(draw.randint(0, 200)))


def test_counts(spark):
    rows = documents() + [(100 + s, repetitive(s), "en", "s", None) for s in range(40)]
    rows += [(200, "a\u00a0b c\u0085d \U0001f600é", "en", "s", None), (201, "x\n x\nx\n\nx", "en", "s", None)]
    found = quality_rules.judge(frame_of(spark, rows))
    assert sorted(counts_of(found), key=str) == sorted(((r[0], *plain(r[1])) for r in rows), key=str)


def test_verdict_does_not_depend_on_the_order(spark):
    docs = frame_of(spark)
    counted = quality_rules.counts(docs).where(~quality_rules.base_failed())
    verdicts = [
        sorted(str(r) for r in counted.select("doc_id", quality_rules.cascade(quality_rules.RULES, order).isNull().alias("kept")).collect())
        for order in (list(quality_rules.RULES), list(reversed(quality_rules.RULES)))
    ]
    assert verdicts[0] == verdicts[1]


def test_cascade_stops_at_the_first_rule_that_rejects(spark):
    rules = {"never": "1 / (n_words - n_words) > 0", "always": "true"}
    df = spark.range(3).selectExpr("id AS n_words")
    assert {r[0] for r in df.select(quality_rules.cascade(rules, ["always", "never"])).collect()} == {"always"}
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(quality_rules.cascade(rules, ["never", "always"])).collect()


def test_order_is_by_rejection_per_cost(spark):
    rows = [(i, prose(i), "en", "s", None) for i in range(60)]
    rules = {"useless": "n_words < 0", "useful": "n_words > 0"}
    assert quality_rules.measured_order(frame_of(spark, rows), rules) == ["useful", "useless"]


def test_rules(spark):
    good = prose(5, 80)
    texts = {
        "symbol_heavy": " ".join(w + "%%%" for w in good.split()), "repeated_lines": good + "\n" + "again\n" * 4,
        "word_length": " ".join(chr(0x4E00 + i) for i in range(60)), "few_letters": " ".join(str(i * 7919) for i in range(80)),
        "bullet_lines": "\n".join(f"- {w} point" for w in good.split()), "ellipsis_lines": "\n".join(f"{w} more ..." for w in good.split()),
    }
    rows = [(i, t, "en", "s", None) for i, t in enumerate([good, *texts.values()])]
    found = {r.doc_id: r for r in quality_rules.judge(frame_of(spark, rows)).collect()}
    assert found[0].kept and found[0].rejected_by is None
    for i, name in enumerate(texts, 1):
        assert not found[i].kept and found[i].rejected_by in (name, "base"), name
    assert {found[i].rejected_by for i in range(1, 7)} >= {"symbol_heavy", "word_length", "few_letters"}


def test_whole_rows_are_kept(spark):
    docs = frame_of(spark)
    kept = quality_rules.keep_good(docs)
    assert kept.schema == docs.schema
    expected = quality_rules.judge(docs).where("kept")
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in expected.collect())


def test_empty_table(spark):
    assert quality_rules.judge(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = quality_rules.judge(frame_of(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
