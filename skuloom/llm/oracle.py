"""The queries for DuckDB, where SQL can express them."""

from __future__ import annotations

from skuloom.llm.quality_rules import ROUNDS

OP3 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p
), f AS (
  SELECT payload_digest, min(page_id) AS original FROM d WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > original THEN original END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""


WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"

OP1 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, * FROM (SELECT DISTINCT doc_id, {WORDS} AS w FROM documents) z),
items AS (SELECT row_number() OVER () AS bid, * FROM (SELECT DISTINCT item_id, {WORDS} AS w FROM benchmark) z WHERE len(w) > 0),
b AS (SELECT * FROM items WHERE len(w) >= 5),
short AS (SELECT item_id, len(w) AS k, array_to_string(w, ' ') AS s FROM items WHERE len(w) < 5),
parts AS (
  SELECT rid, doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM d, (SELECT DISTINCT k FROM short) l, unnest(range(1, len(w) - k + 2)) t(i)
),
ds AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) t(i)),
bs AS (SELECT bid, len(w) - 4 AS n, i, array_to_string(w[i:i + 4], ' ') AS s FROM b, unnest(range(1, len(w) - 3)) t(i)),
starts AS (
  SELECT DISTINCT rid, bid, n, unnest(range(lag - slack, lag + slack + 1)) AS start
  FROM (SELECT rid, bid, n, ds.i - bs.i AS lag, CAST(floor(n * 0.2 + 1e-9) AS BIGINT) AS slack FROM ds JOIN bs USING (s))
),
windows AS (
  SELECT rid, bid, n, start, s, count(*) AS c FROM starts JOIN ds USING (rid) WHERE i > start AND i <= start + n GROUP BY ALL
), item AS (SELECT bid, s, count(*) AS c FROM bs GROUP BY ALL),
both_sides AS (
  SELECT rid, w.bid, n, start, sum(w.c) AS size, sum(CASE WHEN item.c IS NULL THEN 0 ELSE least(w.c, item.c) END) AS common
  FROM windows w LEFT JOIN item ON w.bid = item.bid AND w.s = item.s GROUP BY ALL
), matched AS (
  SELECT doc_id, item_id, n + 4 AS n_words, start, CAST(common AS DOUBLE) / CAST(size + n - common AS DOUBLE) AS similarity
  FROM both_sides JOIN d USING (rid) JOIN b USING (bid) WHERE common >= 0.8 * (size + n - common)
  UNION ALL SELECT doc_id, item_id, k, i - 1, 1.0 FROM parts JOIN short USING (k, s)
)
SELECT doc_id, item_id, similarity, CAST(start AS INTEGER) AS start_word, CAST(n_words AS INTEGER) AS n_words FROM matched
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""

OP2 = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS rank, hex(encode(coalesce(text, ''))) AS h
  FROM documents
), w AS (SELECT rid, rank, p, substr(h, 2 * p + 1, 100) AS s FROM d, unnest(range(0, len(h) // 2 - 49)) t(p)),
f AS (SELECT s, min(rank) AS first FROM w GROUP BY 1),
gone AS (SELECT rid, p FROM w JOIN f USING (s) WHERE first < rank),
marked AS (SELECT *, coalesce(p > lag(p) OVER o + 50, true) AS new FROM gone WINDOW o AS (PARTITION BY rid ORDER BY p)),
numbered AS (SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY rid ORDER BY p) AS span FROM marked),
spans AS (SELECT rid, span, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY ALL),
placed AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM spans),
removed AS (
  SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM placed JOIN d USING (rid) GROUP BY rid
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN removed USING (rid)
"""

OP6 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
sets AS (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS g FROM d
), s AS (SELECT rid, len(g) AS n, unnest(g) AS x FROM sets),
links AS (
  SELECT a.rid AS a, b.rid AS b FROM s a JOIN s b ON a.x = b.x AND a.rid <> b.rid
  GROUP BY a.rid, b.rid, a.n, b.n HAVING count(*) * 5 >= 4 * (a.n + b.n - count(*))
), reached AS (SELECT rid, rid AS other FROM d UNION SELECT rid, b FROM reached JOIN links ON other = a),
classes AS (SELECT r.rid, min(o.doc_id) AS class_id FROM reached r JOIN d o ON r.other = o.rid GROUP BY 1),
counts AS (SELECT a AS rid, count(*) AS n FROM links GROUP BY 1)
SELECT doc_id, class_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
  CASE WHEN len(g) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY g) END AS set_id
FROM sets JOIN classes USING (rid) LEFT JOIN counts USING (rid)
"""

RULES = {
    "length": ("n_words >= 50", "n_words < 20"),
    "word_length": ("word_chars BETWEEN 3 * n_words AND 12 * n_words", "word_chars < 2 * n_words OR word_chars > 16 * n_words"),
    "symbols": ("n_symbols * 50 <= n_words", "n_symbols * 8 > n_words"),
    "lines": ("n_dup_lines * 10 <= n_lines", "n_dup_lines * 2 > n_lines"),
    "repeats": ("n_repeat_words * 50 <= n_words", "n_repeat_words * 10 > n_words * 3"),
    "variety": ("variety >= 4", "variety < 2"),
    "sentences": ("n_ends * 100 >= n_words AND n_ends * 3 <= n_words", "n_ends = 0 OR n_ends > n_words"),
    "marks": ("(word_chars - n_alnum) * 16 <= word_chars", "(word_chars - n_alnum) * 10 > word_chars"),
    "capitals": ("n_capitals * 5 <= word_chars", "n_capitals * 5 > word_chars * 2"),
}
VOTES = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS vote_{k}" for k, (good, bad) in RULES.items())
NAMES = ", ".join(f"vote_{k}" for k in RULES)
SPACES = r"[\x20\x09-\x0D]"


def chars(pattern: str) -> str:
    return f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"


def odds(on_good: str, on_bad: str) -> str:
    """Log odds of the votes under two lists of how often rules are right."""
    terms = [
        f"CASE vote_{k} WHEN 1 THEN ln({on_good}[{i}] / (1 - {on_bad}[{i}])) WHEN -1 THEN ln((1 - {on_good}[{i}]) / {on_bad}[{i}]) ELSE 0 END"
        for i, k in enumerate(RULES, 1)
    ]
    return " + ".join(["ln(good / (1 - good))", *terms])


def shares(weight: str, right: int, belief: float) -> str:
    return ", ".join(
        f"(sum(CASE WHEN vote_{k} = {right} THEN n * {weight} ELSE 0 END) + {belief} * max(held))"
        f" / (sum(CASE WHEN vote_{k} <> 0 THEN n * {weight} ELSE 0 END) + max(held))"
        for k in RULES
    )


OP10 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT rid, list_filter(regexp_split_to_array(t, '{SPACES}+'), lambda x: x <> '') AS w FROM d),
grams AS (SELECT rid, i, w[i:i + 7] AS g FROM words, unnest(range(1, len(w) - 6)) u(i)),
often AS (SELECT rid, g FROM grams GROUP BY ALL HAVING count(*) > 1),
repeated AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM grams JOIN often USING (rid, g), unnest(range(0, 8)) u(k) GROUP BY 1
), lines AS (
  SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), counts AS (
  SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST({chars('[#*$%&|<>]')} AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines, {chars('[.!?]')} AS n_ends,
    {chars(r'\p{Lu}')} AS n_capitals, {chars(r'[\p{L}\p{N}]')} AS n_alnum,
    len(list_distinct(w)) / sqrt(greatest(len(w), 1)) AS variety
  FROM d JOIN words USING (rid) JOIN lines USING (rid) LEFT JOIN repeated USING (rid)
), voted AS (SELECT *, {VOTES} FROM counts),
patterns AS (
  SELECT {NAMES}, CAST(count(*) AS DOUBLE) AS n, 0.02 * (SELECT count(*) FROM d) + 1 AS held, (SELECT count(*) FROM d) AS total
  FROM voted GROUP BY ALL
), em(step, good, a, b) AS (
  SELECT 0, 0.8::DOUBLE, list_transform(range({len(RULES)}), lambda x: 0.995::DOUBLE), list_transform(range({len(RULES)}), lambda x: 0.25::DOUBLE)
  UNION ALL
  SELECT step + 1, (sum(n * p) + 0.8 * max(held)) / (max(total) + max(held)),
    [{shares('p', 1, 0.995)}], [{shares('(1 - p)', -1, 0.25)}]
  FROM (SELECT *, 1 / (1 + exp(-({odds('a', 'b')}))) AS p FROM em, patterns WHERE step < {{rounds}}) z GROUP BY step
), judged AS (
  SELECT *, 1 / (1 + exp(-({odds('a', 'b')}))) AS p, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS failed
  FROM voted, (SELECT * FROM em WHERE step = {{rounds}}) z
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
  NOT failed AND p >= 0.5 AS kept, round(p, 4) AS posterior, {NAMES} FROM judged
""".replace("{rounds}", str(ROUNDS))

OP13 = r"""
WITH l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id
), t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), d AS (
  SELECT t.*, good, bad,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), min(t.doc_id) OVER (PARTITION BY text) IS NOT NULL) THEN 'E' ELSE '' END AS f
  FROM t LEFT JOIN l ON t.doc_id = l.doc_id
), m AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good = 1) AS good, count(*) FILTER (bad = 1) AS bad FROM d GROUP BY ALL
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS x, '[' || filter_order[:step] || ']' AS upto,
    CASE WHEN step = 1 THEN '[^A-E]' ELSE '[' || filter_order[:step - 1] || ']' END AS before
  FROM o, unnest(range(1, 6)) u(step)
), z AS (
  SELECT part, filter_order, step, x,
    sum(CASE WHEN regexp_matches(f, upto) THEN 0 ELSE n END) AS kept,
    sum(CASE WHEN contains(f, x) AND NOT regexp_matches(f, before) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(f, x) AND regexp_matches(f, before) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN f = x THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(f, x) AND NOT regexp_matches(f, before) THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(f, x) AND NOT regexp_matches(f, before) THEN bad ELSE 0 END) AS toxic_lost
  FROM m, s GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM z
"""

ORACLE: dict[str, str] = {
    "op1_decontamination": OP1, "op2_suffix_dedup": OP2, "op3_warc": OP3, "op6_ngram_join": OP6, "op10_quality_rules": OP10,
    "op13_filter_audit": OP13,
}
