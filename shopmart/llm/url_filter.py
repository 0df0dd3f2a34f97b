"""URL filter by two character language models, in DataFrame operations only.

Fixed rules decide the urls that they fit. The others are judged by smoothed variable-order Markov
models, one of the urls that rules allow and one of those that they block. Order-k probabilities
are Witten-Bell mixtures: with n(c) followers c of a context, n followers in all and t different
ones, p_k(c) = (n(c) + t * p_(k-1)(c)) / (n + t), down to a uniform p_0; so each character is
predicted by the longest context that was seen, smoothed by the shorter ones. A url's score is the
mean over its characters of ln p_allowed - ln p_blocked. The threshold is calibrated on a fifth of
the labelled urls that the models have not seen: it balances the shares of wrongly blocked and
wrongly allowed ones.

Each different url counts once, so copies of a page do not weigh. Counts of the longest strings are
aggregated from all urls, and those of shorter ones from them. Probabilities are worked out once for
each different string, then joined to the urls' characters: an ordinary sort-merge join whose
skewed partitions adaptive execution splits. Nothing but the calibration histogram, of fixed size,
reaches the driver.

The models read whole urls, scheme, query and fragment included; host and path serve the rules alone.
Urls of one host and path are either all learnt from or all kept for calibration.

Defined results: a null url or one without ``://`` has empty host and path and fits no rule; a null
url is judged as the empty one, any other by what it holds; with urls of one class only, the other model stays uniform and the
threshold is 0; repeated rows repeat in the result; an empty table gives no rows; only the id and
url columns are read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopmart.llm.common import stored

# Rules as (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: A character and up to ORDER before it.
ORDER = 4
#: Characters that p_0 spreads over.
ALPHABET = 256
CALIBRATION_SHARE = 5
#: Scores are counted in steps of 1 / SCORE_STEPS between -SCORE_LIMIT and SCORE_LIMIT.
SCORE_STEPS, SCORE_LIMIT = 100, 20
#: Urls are cut into pieces of so many characters before they are cut into strings.
PIECE = 256

_BEFORE, _END = "\u0002", "\u0003"


def parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path."""
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.expr("substring(u, instr(u, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fits(host: str, path: str) -> Column:
    same = (F.col("host") == host) | F.col("host").endswith("." + host)
    return same & F.col("path").startswith(path)


def ruled(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str, url_col: str) -> DataFrame:
    """page_id, u (the whole url), host, path, the longest fitting rule and its verdict."""
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("u"))
    host, path = parts(F.col("u"))
    found = urls.select("page_id", "u", host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        rule, verdict = F.when(fits(h, p), h + p).otherwise(rule), F.when(fits(h, p), v).otherwise(verdict)
    return found.withColumns({"rule": rule, "rule_verdict": verdict})


def strings(urls: DataFrame, order: int) -> DataFrame:
    """A row for each character of the url u, and one for its end, with the ``order`` characters before."""
    padded = F.concat(F.lit(_BEFORE * order), F.col("u"), F.lit(_END))
    cut = f"transform(sequence(0, (length(padded) - {order} - 1) DIV {PIECE}), i -> substring(padded, i * {PIECE} + 1, {PIECE + order}))"
    whole = urls.withColumn("padded", padded).withColumn("piece", F.explode(F.expr(cut)))
    each = f"transform(sequence(1, length(piece) - {order}), i -> substring(piece, i, {order + 1}))"
    return whole.withColumn("gram", F.explode(F.expr(each))).drop("padded", "piece", "u", "host", "path")


def log_ratios(counts: DataFrame, order: int) -> DataFrame:
    """gram, ratio: ln p_allowed - ln p_blocked of the last character of each counted string.

    ``counts`` has gram, allowed and blocked, with zeros for strings seen in other urls only.
    """
    levels = [counts]
    for k in range(order, 0, -1):
        shorter = levels[-1].groupBy(F.expr(f"right(gram, {k})").alias("gram"))
        levels.append(shorter.agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")))
    known = None
    for k, level in enumerate(reversed(levels), start=1):
        context = F.expr(f"left(gram, {k - 1})")
        # Contexts are many and short-followed, but the empty one is all of its level: sum it plainly.
        totals = level.groupBy(context.alias("context")).agg(*[
            f(F.col(c)).alias(f"{c}_{name}")
            for c in ("allowed", "blocked")
            for name, f in (("n", F.sum), ("t", lambda x: F.sum((x > 0).cast("long"))))
        ])
        found = level.withColumn("context", context).join(totals, "context")
        if known is None:
            found = found.withColumns({f"{c}_p": F.lit(1 / ALPHABET) for c in ("allowed", "blocked")})
        else:
            found = found.withColumn("tail", F.expr(f"right(gram, {k - 1})")).join(known.withColumnRenamed("gram", "tail"), "tail")
        mixed = {
            c: F.when(
                F.col(f"{c}_n") > 0,
                (F.col(c) + F.col(f"{c}_t") * F.col(f"{c}_p")) / (F.col(f"{c}_n") + F.col(f"{c}_t")),
            ).otherwise(F.col(f"{c}_p")).alias(f"{c}_p")
            for c in ("allowed", "blocked")
        }
        known = found.select("gram", *mixed.values())
    return known.select("gram", (F.log("allowed_p") - F.log("blocked_p")).alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """Score that balances the shares of wrongly blocked and wrongly allowed urls best."""
    step = F.round(F.greatest(F.lit(-SCORE_LIMIT), F.least(F.lit(SCORE_LIMIT), F.col("score"))) * SCORE_STEPS).cast("int")
    rows = scored.groupBy(step.alias("at"), "rule_verdict").count().collect()
    n = {v: sum(r["count"] for r in rows if r["rule_verdict"] == v) for v in ("allow", "block")}
    if not all(n.values()):
        return 0.0
    wrong, best = 1.0, (float("inf"), 0.0, 0.0)  # below all scores everything is allowed
    for at in sorted({r["at"] for r in rows}):
        best = min(best, (wrong, abs(at - 0.5), (at - 0.5) / SCORE_STEPS))
        for r in rows:
            if r["at"] == at:
                wrong += r["count"] / n[r["rule_verdict"]] * (1 if r["rule_verdict"] == "allow" else -1)
    return best[2]


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, order: int = ORDER,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict and the models' score (null where a rule decides)."""
    marked = ruled(pages, rules, id_col, url_col)
    learnt = F.pmod(F.xxhash64("host", "path"), F.lit(CALIBRATION_SHARE)) != 0
    urls = stored(marked.select("u", "host", "path", "rule_verdict").distinct(), "urls")
    urls = urls.withColumns({"learnt": learnt, "url_id": F.monotonically_increasing_id()})
    grams = strings(urls, order)
    hit = {v: F.count(F.when((F.col("rule_verdict") == v) & F.col("learnt"), 1)) for v in ("allow", "block")}
    counts = grams.groupBy("gram").agg(hit["allow"].alias("allowed"), hit["block"].alias("blocked"))
    ratios = stored(log_ratios(stored(counts, "counts"), order), "ratios")
    asked = grams.where("rule_verdict IS NULL OR NOT learnt").select("url_id", "gram")
    scores = asked.join(ratios, "gram").groupBy("url_id").agg(F.avg("ratio").alias("score"))
    scored = stored(urls.join(scores, "url_id").select("u", "rule_verdict", "score"), "scores")
    least = threshold(scored.where("rule_verdict IS NOT NULL"))
    open_urls = scored.where("rule_verdict IS NULL").select("u", "score")
    found = marked.join(open_urls, "u", "left")
    own = F.when(F.col("score") >= least, "allow").otherwise("block")
    return found.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score")
