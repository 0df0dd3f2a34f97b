"""Reference SQL (DuckDB) for the numbered queries that SQL can express, over whole tables."""

from __future__ import annotations

from shopmart.llm import licenses, negatives, quality_rules, ranking, secret_scan, topk

TOPK = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({topk.SCALE} * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, v.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scored QUALIFY rank <= {topk.K}"""

NEGATIVES = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor({negatives.SCALE} * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, v.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS a JOIN v ON v.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {negatives.POSITIVES})
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {negatives.LOW} * positive_score <= 100 * score AND 100 * score <= {negatives.HIGH} * positive_score
QUALIFY rank <= {negatives.K}"""

RANKING = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
held AS (SELECT rid, doc_id, words, len(words) AS n FROM d WHERE len(words) > 0),
size AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS total FROM held),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(min(text), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id),
item_terms AS (SELECT item_id, term, count(*)::BIGINT AS repeats FROM asked GROUP BY item_id, term),
tf AS (
  SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT rid, doc_id, n, unnest(words) AS term FROM held)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY rid, doc_id, n, term),
weights AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, size GROUP BY term, n_docs),
scored AS (
  SELECT item_id, rid, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // total))))::BIGINT AS score
  FROM tf JOIN weights USING (term) JOIN item_terms USING (term), size GROUP BY item_id, rid, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {ranking.K}"""


def _licenses() -> str:
    templates = ", ".join(
        f"({n}, '{phrase}', '{label}', {base})"
        for n, (phrase, label, base) in enumerate([
            *((p, x, True) for p, x in licenses.BASE.items()), *((p, x, False) for p, x in licenses.TEMPLATES.items())
        ])
    )
    k, near = licenses.GRAM_WORDS, licenses.NEAR
    upper = "".join(map(chr, range(65, 91)))
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{licenses._NO_WORD}'), lambda x: x <> '') AS words
  FROM documents),
phrases AS (
  SELECT template, string_split(phrase, ' ') AS words, label, base, len(string_split(phrase, ' ')) - {k - 1} AS grams
  FROM (VALUES {templates}) AS t(template, phrase, label, base)),
template_grams AS (
  SELECT template, label, base, grams, place, words[place + 1 : place + {k}] AS gram FROM phrases, unnest(range(grams)) AS r(place)),
text_grams AS (SELECT rid, place AS word, words[place + 1 : place + {k}] AS gram FROM texts, unnest(range(len(words) - {k - 1})) AS r(place)),
votes AS (
  SELECT rid, template, label, base, grams, word - place AS diagonal, list(DISTINCT place) AS held,
    min(word) AS first, max(word) + {k} AS past
  FROM text_grams JOIN template_grams USING (gram) GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN NOT base AND diagonal - lag(diagonal) OVER w <= {near} AND first <= lag(past) OVER w + {near}
      AND lag(first) OVER w <= past + {near} THEN 0 ELSE 1 END AS opens
  FROM votes WINDOW w AS (PARTITION BY rid, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY rid, template ORDER BY diagonal) AS span FROM marked),
merged AS (
  SELECT rid, label, base, grams, len(list_distinct(flatten(list(held)))) / grams::DOUBLE AS share, min(first) AS first,
    max(past) - min(first) AS length
  FROM numbered GROUP BY rid, template, label, base, grams, span),
spans AS (
  SELECT * FROM merged WHERE CASE WHEN base THEN share = 1 ELSE share >= {licenses.LEAST_SHARE}
    AND length <= {licenses.MOST_LENGTH} * (grams + {k - 1}) END),
found AS (
  SELECT rid, count(*) FILTER (WHERE base) AS n_base, min(first) FILTER (WHERE base) AS first_word,
    max(first) FILTER (WHERE base) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE base))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(share) AS score
  FROM spans GROUP BY rid)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM texts LEFT JOIN found USING (rid)"""


def _secrets() -> str:
    def matches(n: int, rule: secret_scan.Rule) -> str:
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        return f"""
  SELECT rid, {n} AS number, '{rule.kind}' AS kind, length(found[i]) AS size,
    coalesce(list_sum(list_transform(gap[1:i], lambda x: length(x))), 0)::BIGINT
      + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0)::BIGINT AS first
  FROM (SELECT rid, regexp_extract_all(text, {pattern}, 0) AS found, regexp_extract_all(text, {pattern}, {rule.group}) AS value,
    string_split_regex(text, {pattern}) AS gap FROM texts), unnest(range(1, len(found) + 1)) AS r(i)
  WHERE length(value[i]) >= {rule.least}"""

    rules = secret_scan.BASE + secret_scan.ADDED
    listed = "string_agg(kind || ':' || first || ':' || (first + size), ',' ORDER BY first, number)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{rule.kind}') AS n_{rule.kind}" for rule in secret_scan.BASE)
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(matches(n, rule) for n, rule in enumerate(rules))}),
found AS (
  SELECT rid, {counts}, {listed} FILTER (WHERE number < {len(secret_scan.BASE)}) AS base, {listed} AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in secret_scan.BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (rid)"""


def _quality() -> str:
    blank, k = r"[ \t\n\x0b\f\r]+", quality_rules.WINDOW_WORDS
    poor = [
        "20 * n_symbols > word_chars",
        "n_dup_lines > n_lines",
        "word_chars < 2 * n_words OR word_chars > 16 * n_words",
        r"10 * length(regexp_replace(text, '[^\p{L}]+', '', 'g')) < 5 * word_chars",
        r"10 * len(regexp_extract_all(text, '(\.\.\.|…)[ \t]*(\n|$)')) > 3 * n_lines",
        r"10 * len(regexp_extract_all(text, '(^|\n)[ \t]*[•*-] ')) > 9 * n_lines",
    ]
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, text, list_filter(string_split_regex(text, '{blank}'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{blank}', '', 'g') <> '') AS lines
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
windows AS (
  SELECT rid, place, array_to_string(words[place : place + {k - 1}], ' ') AS w FROM texts, unnest(range(1, len(words) - {k - 2})) AS r(place)),
twice AS (SELECT rid, place FROM windows QUALIFY count(*) OVER (PARTITION BY rid, w) > 1),
covered AS (SELECT rid, count(DISTINCT place + k) AS n FROM twice, range({k}) AS r(k) GROUP BY rid),
counted AS (
  SELECT doc_id, text, len(words) AS n_words, length(regexp_replace(text, '{blank}', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(list_distinct(lines)) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM texts LEFT JOIN covered USING (rid)),
judged AS (SELECT *, n_words < {quality_rules.LEAST_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({" OR ".join(f"({p})" for p in poor)}) AS kept
FROM judged"""


def statements() -> dict[str, str]:
    return {"op1_topk": TOPK, "op11_secrets": _secrets(), "op12_ranking": RANKING, "op13_negatives": NEGATIVES, "op4_licenses": _licenses(), "op6_quality": _quality()}
