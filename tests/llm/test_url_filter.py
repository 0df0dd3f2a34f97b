from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from text_cases import empty

from shopmart.llm import url_filter

SCHEMA = "page_id long, url string, html string, score int, gram string, rule string"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[end:]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]


def plain_rule(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def plain_ratio(url, allowed, blocked, order):
    """Mean log ratio of two models, straight from the definition."""

    def model(urls):
        followers = defaultdict(Counter)
        for u in urls:
            s = "\2" * order + u + "\3"
            for i in range(order, len(s)):
                for k in range(order + 1):
                    followers[s[i - k : i]][s[i]] += 1

        def p(context, c):
            if context is None:
                return 1 / url_filter.ALPHABET
            shorter = p(context[1:] if context else None, c)
            seen = followers.get(context)
            n, t = (sum(seen.values()), len(seen)) if seen else (0, 0)
            return (seen[c] + t * shorter) / (n + t) if n else shorter

        return p

    a, b = model(allowed), model(blocked)
    s = "\2" * order + url + "\3"
    ratios = [math.log(a(s[i - order : i], s[i]) / b(s[i - order : i], s[i])) for i in range(order, len(s))]
    return sum(ratios) / len(ratios)


def urls(n=160):
    draw = random.Random(4)
    found = []
    for i in range(n):
        host = draw.choice(["", "www.", "M.", "blog."]) + draw.choice(["alpha", "beta", "cheap-pills"]) + ".example." + draw.choice(["com", "net", "org", "COM"])
        path = f"/{draw.choice(['en', 'es', 'fr', 'de'])}/{draw.randint(0, 99)}{draw.choice(['', '/', '.html'])}"
        found.append((i, f"http{draw.choice(['', 's'])}://{host}{path}{draw.choice(['', '?a=b/c', '#top', '?x#y'])}"))
    odd = [None, "", "no-scheme/en/", "://", "http://", "http://com", "http://com/", "x://a.com?b=/x", "http://NET/es/é", "a://b://c.net/fr/", "http://notcom/en/", "http://example.com/EN/", "HTTP://www.Example.com/en/" + "y" * 900]
    found += [(None if k == 3 else 1000 + k, u) for k, u in enumerate(odd)] + found[:5]
    return [(i, u, None, 1, "g", "r") for i, u in found]


def test_parts_rules_and_scores(spark):
    rows = urls()
    found = url_filter.judge(spark.createDataFrame(rows, SCHEMA).repartition(3), order=3).collect()
    expected = Counter((i, *plain_parts(u), plain_rule(*plain_parts(u))[0]) for i, u, *_ in rows)
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in found) == expected
    distinct = {u or "" for _, u, *_ in rows}
    pairs = spark.createDataFrame(list({plain_parts(u) for u in distinct}), "host string, path string")
    learnt = {(r.host, r.path) for r in pairs.where(f"pmod(xxhash64(host, path), {url_filter.CALIBRATION_SHARE}) != 0").collect()}
    by = {v: [u for u in distinct if plain_parts(u) in learnt and plain_rule(*plain_parts(u))[1] == v] for v in ("allow", "block")}
    whole = {i: u or "" for i, u, *_ in rows if i is not None and Counter(r[0] for r in rows)[i] == 1}
    for r in found:
        if r.page_id not in whole:
            continue
        verdict = plain_rule(r.host, r.path)[1]
        if verdict:
            assert r.verdict == verdict and r.score is None
        else:
            assert r.score == pytest.approx(plain_ratio(whole[r.page_id], by["allow"], by["block"], 3))
    least = min(r.score for r in found if r.score is not None and r.verdict == "allow")
    assert all(r.score < least for r in found if r.score is not None and r.verdict == "block")


def test_urls_are_judged_whole(spark):
    """Scheme, query and fragment tell urls apart, and so does what a url without a host holds."""
    rows = [(i, f"http://a{i}.com/x?ok={i}", None, 1, "", "") for i in range(40)]
    rows += [(100 + i, f"http://b{i}.net/es/?spam={i}#win", None, 1, "", "") for i in range(40)]
    open_urls = ["http://c.org/x?ok=7", "http://c.org/x?spam=7#win", "ok=7", "spam=7#win", ""]
    rows += [(200 + i, u, None, 1, "", "") for i, u in enumerate(open_urls)]
    found = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len({found[200 + i].score for i in range(5)}) == 5
    assert found[200].score > found[201].score and found[202].score > found[203].score
    assert (found[201].host, found[201].path, found[202].host) == ("c.org", "/x", "")


def test_threshold_balances_errors(spark):
    rows = [(0.9, "allow")] * 9 + [(-0.5, "allow")] + [(-0.9, "block")] * 9 + [(0.3, "block")]
    scored = spark.createDataFrame(rows, "score double, rule_verdict string")
    assert -0.9 < url_filter.threshold(scored) <= 0.9
    at = url_filter.threshold(scored)
    assert sum((s >= at) != (v == "allow") for s, v in rows) == 1
    assert url_filter.threshold(scored.where("rule_verdict = 'allow'")) == 0
    assert url_filter.threshold(scored.where("false")) == 0


def test_urls_of_one_class_and_none(spark):
    one = spark.createDataFrame([(1, "http://a.com/x", None, 1, "", ""), (2, "http://a.org/x", None, 1, "", "")], SCHEMA)
    assert {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(one).collect()}[1] == ("com/", "allow")
    assert url_filter.judge(empty(spark, SCHEMA)).count() == 0


def test_long_urls_are_cut_without_loss(spark, monkeypatch):
    df = spark.createDataFrame([("h/" + "".join(chr(97 + i % 26) for i in range(100)),)], "u string")
    whole = Counter(r.gram for r in url_filter.strings(df, 4).collect())
    monkeypatch.setattr(url_filter, "PIECE", 7)
    assert Counter(r.gram for r in url_filter.strings(df, 4).collect()) == whole and sum(whole.values()) == 103


def test_no_python_in_the_plan(spark):
    plan = url_filter.judge(spark.createDataFrame(urls(20), SCHEMA))._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Arrow" not in plan and "BatchEvalPython" not in plan
