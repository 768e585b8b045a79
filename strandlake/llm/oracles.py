"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import math

from . import decontamination, line_dedup, mixing, quality_rules, suffix_dedup, word_windows

WORD = r"[^\x20\x09-\x0D]+"


def quality_sql() -> str:
    rules, risk, level = quality_rules.RULES, quality_rules.RISK, quality_rules.LEVEL
    steps = range(len(next(iter(rules.values()))))
    tail = f"list_sum(list_transform(range(0, {{k}} + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * {math.log(risk)!r} + (n - i) * {math.log1p(-risk)!r})))"
    counted = ", ".join(f"count(*) FILTER (WHERE {' OR '.join(f'{r} > {c[i]}' for r, c in rules.items())}) AS f_{i}" for i in steps)
    passes = [f"(f_{i} <= n * {risk!r} AND {tail.format(k=f'f_{i}')} <= {level!r} / strata)" for i in steps]
    last = f"CASE {' '.join(f'WHEN NOT {p} THEN {i}' for i, p in enumerate(passes))} ELSE {len(passes)} END"
    chosen = ", ".join(f"({list(c)!r})[last] AS {r}_cut" for r, c in rules.items())
    over = " OR ".join(f"coalesce({r} > {r}_cut, false)" for r in rules)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS body,
             regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
f0 AS (SELECT rid, doc_id, stratum, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines,
         len(list_filter(w, lambda x: length(x) > 2 AND translate(right(x, 2), '{quality_rules.MARKS}', '') = '')) AS n_shouted FROM d),
win AS (SELECT rid, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
txt AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS t FROM win),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS n FROM txt) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT p)::BIGINT AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY rid),
f AS (SELECT f0.rid, doc_id, stratum, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(cov.n, 0) AS n_repeat_words, CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_share,
        CASE WHEN len(lines) > 0 THEN (len(lines) - len(list_distinct(lines))) / len(lines) ELSE 0 END AS dup_line_share,
        CASE WHEN n_words > 0 THEN coalesce(cov.n, 0) / n_words ELSE 0 END AS repeat_share,
        CASE WHEN n_words > 0 THEN n_shouted / n_words ELSE 0 END AS shout_share FROM f0 LEFT JOIN cov USING (rid)),
b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM f),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING max(quality) = 1),
held AS (SELECT DISTINCT ON (doc_id) * FROM b WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good) ORDER BY doc_id, stratum, {', '.join(rules)}),
cnt AS (SELECT stratum, count(*) AS n, {counted} FROM held GROUP BY stratum),
tested AS (SELECT *, {last} AS last FROM (SELECT *, count(*) OVER () AS strata FROM cnt)),
cut AS (SELECT stratum, {chosen} FROM tested)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR {over}) AS kept,
  round(symbol_share, 6) AS symbol_share, round(shout_share, 6) AS shout_share
FROM b LEFT JOIN cut USING (stratum)"""


def decontamination_sql() -> str:
    lower = "translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = "regexp_extract_all(" + lower + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    size = decontamination.WINDOW
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words.format(t="text")} AS w FROM documents),
b AS (SELECT row_number() OVER () AS bid, coalesce(item_id::VARCHAR, '') AS item, {words.format(t="text")} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM (SELECT item, w, least({size}, len(w)) AS n, unnest(range(1, len(w) - least({size}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT rid, i, dw.n, item FROM dw JOIN bw ON bw.n = dw.n AND bw.t = dw.t),
pos AS (SELECT DISTINCT rid, unnest(range(i, i + n)) AS p FROM hit),
isl AS (SELECT rid, p, p - row_number() OVER (PARTITION BY rid ORDER BY p) AS g FROM pos),
runs AS (SELECT rid, min(p) - 1 AS a, max(p) AS z FROM isl GROUP BY rid, g),
cov AS (SELECT rid, sum(z - a)::BIGINT AS n_hit, string_agg(a || ':' || z, ',' ORDER BY a) AS hit_runs FROM runs GROUP BY rid),
its AS (SELECT rid, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid),
bp AS (SELECT bid, j, w[j] AS word FROM (SELECT bid, w, unnest(range(1, len(w) + 1)) AS j FROM b)),
eq AS (SELECT rid, p, bid, p - j AS diag FROM (SELECT rid, p, w[p] AS word FROM pos JOIN d USING (rid)) JOIN bp USING (word)),
chain AS (SELECT rid, bid, diag, p - row_number() OVER (PARTITION BY rid, bid, diag ORDER BY p) AS g FROM eq),
most AS (SELECT rid, max(n)::BIGINT AS longest FROM (SELECT rid, count(*) AS n FROM chain GROUP BY rid, bid, diag, g) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND {decontamination.SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(longest, 0) AS longest_match, coalesce(hit_runs, '') AS hit_runs
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid) LEFT JOIN most USING (rid)"""


def suffix_dedup_sql() -> str:
    n = suffix_dedup.LENGTH
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT rid, doc_id, h, unnest(range(0, length(h) // 2 - {n - 1})) AS p FROM d WHERE length(h) >= {2 * n}),
m AS (SELECT rid, doc_id, p, md5(substr(h, 2 * p + 1, {2 * n})) AS s FROM w),
late AS (SELECT rid, p FROM (SELECT rid, p, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS LAST, rid, p) AS k FROM m) WHERE k > 1),
cut AS (SELECT rid, p, CASE WHEN p - lag(p) OVER (PARTITION BY rid ORDER BY p) <= {n} THEN 0 ELSE 1 END AS fresh FROM late),
num AS (SELECT rid, p, sum(fresh) OVER (PARTITION BY rid ORDER BY p) AS run FROM cut),
runs AS (SELECT rid, min(p) AS a, max(p) + {n} AS b FROM num GROUP BY rid, run),
gaps AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS begin FROM runs),
kept AS (SELECT rid, string_agg(substr(h, 2 * begin + 1, 2 * (a - begin)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS k, sum(b - a)::BIGINT AS removed, count(*)::BIGINT AS spans FROM gaps JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256 FROM d LEFT JOIN kept USING (rid)"""


def passages_sql() -> str:
    n = word_windows.WINDOW
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
m AS (SELECT rid, coalesce(doc_id, {word_windows.NULL_ID}) AS doc, unnest(range(1, len(w) - {n - 2})) AS i, unnest([md5(array_to_string(w[j:j + {n - 1}], ' ')) for j in range(1, len(w) - {n - 2})]) AS s FROM d WHERE len(w) >= {n}),
late AS (SELECT rid, i FROM (SELECT rid, i, doc, min(doc) OVER (PARTITION BY s) AS least FROM m) WHERE least < doc),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + {n})) AS i FROM late),
words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS k FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (rid)"""


def line_dedup_sql() -> str:
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS site, coalesce(text, '') AS body FROM documents),
l AS (SELECT rid, doc_id, site, generate_subscripts(x, 1) AS i, unnest(x) AS line FROM (SELECT *, string_split(body, chr(10)) AS x FROM d)),
wide AS (SELECT line FROM l WHERE regexp_matches(line, '{WORD}') GROUP BY line HAVING count(DISTINCT site) >= {line_dedup.MIN_SITES}),
m AS (SELECT l.*, regexp_matches(line, '{WORD}') AS worded, line IN (SELECT line FROM wide) AS gone FROM l)
SELECT doc_id, count(*) FILTER (WHERE worded)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id"""


def mixing_sql() -> str:
    dims = ("source", "lang", "topic")
    goals = ", ".join(f"{d}_goal AS (SELECT {d}, p / sum(p) OVER () AS {d}_target FROM (SELECT {d}, pow(sum(tokens)::DOUBLE, {mixing.TEMPERATURE}) AS p FROM cells GROUP BY {d}))" for d in dims)
    steps, last = [], "w0"
    for sweep in range(mixing.SWEEPS):
        for d in dims:
            now = f"w{sweep}_{d}"
            steps.append(f"{now} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(weight) OVER (PARTITION BY {d}) > 0 THEN weight * {d}_target / sum(weight) OVER (PARTITION BY {d}) ELSE 0 END AS weight) FROM {last})")
            last = now
    return rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN regexp_matches(coalesce(text, ''), '[#*$%&|<>]{{2}}') THEN 'marked' ELSE 'prose' END AS topic,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n_tokens FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY ALL), {goals},
w0 AS MATERIALIZED (SELECT *, tokens::DOUBLE AS weight FROM cells JOIN source_goal USING (source) JOIN lang_goal USING (lang) JOIN topic_goal USING (topic)),
{", ".join(steps)},
r AS (SELECT *, CASE WHEN weight > 0 THEN tokens / weight END AS room FROM {last}),
full_cells AS (SELECT *, coalesce(sum(tokens) FILTER (WHERE room IS NOT NULL) OVER o, 0) AS ft, coalesce(sum(weight) OVER o, 0) AS fw, sum(weight) OVER () AS total,
    least({mixing.FRACTION} * sum(tokens) OVER (), sum(tokens) FILTER (WHERE weight > 0) OVER ()) AS budget
  FROM r WINDOW o AS (ORDER BY room ASC NULLS LAST, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT *, CASE WHEN room IS NOT NULL AND total - fw > 1e-12 THEN (budget - ft) / (total - fw) END AS level FROM full_cells),
held AS (SELECT *, coalesce(first_value(CASE WHEN level <= room * (1 + 1e-12) THEN level END) OVER p, max(room) OVER ()) AS held FROM lev
  WINDOW p AS (ORDER BY CASE WHEN level <= room * (1 + 1e-12) THEN 0 ELSE 1 END, room, level ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
share AS (SELECT source, lang, topic, weight / total AS w, CASE WHEN tokens = 0 THEN 1.0 WHEN weight <= 0 THEN 0.0 ELSE least(1.0, held * weight / tokens) END AS keep FROM held)
SELECT doc_id, source, lang, topic, n_tokens, round(w, 6) AS cell_weight, round(keep, 6) AS keep_prob,
  CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{mixing.SEED}'), 1, 13) AS BIGINT) / {float(1 << 52)} < keep AS selected
FROM d JOIN share USING (source, lang, topic)"""
