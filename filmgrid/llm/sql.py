"""SQL that the registered queries must agree with, as far as SQL can say what they do."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = r"[\x20\x09-\x0D]"

# a level's prior strength from groups (n, k, m), as in the operators: moments of the intra-class correlation
_STRENGTH = """1 / least(greatest(CASE WHEN sum(m * (1 - m) * (n - 1)) > 0
  THEN (sum(n * (k / n - m) * (k / n - m)) - sum(m * (1 - m))) / sum(m * (1 - m) * (n - 1)) ELSE 1 / 11 END, 0.001), 1 / 11) - 1"""

QUALITY = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda w: w <> '') AS words FROM documents),
w AS (SELECT doc_id, i, array_to_string(words[i + 1 : i + 8], ' ') AS key
      FROM (SELECT doc_id, words, unnest(range(0, greatest(0, len(words) - 7))) AS i FROM d)),
r AS (SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY doc_id, key) > 1),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM r, (SELECT unnest(range(0, 8)) AS j) GROUP BY 1),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
b AS (SELECT doc_id, source, len(words) AS n_words, length(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words FROM d JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS k FROM f GROUP BY 1),
m AS (SELECT *, (sum(k) OVER () + 0.5) / (sum(n) OVER () + 1) AS m FROM h),
s AS (SELECT {_STRENGTH} AS c FROM m),
p AS (SELECT source, (k + c * m) / (n + c) AS rate, n + c AS total FROM m, s),
v AS (SELECT source, rate - 1.645 * sqrt(rate * (1 - rate) / (total + 1)) > 0.5 AS rejected FROM p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source"""

_URL = f"""
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
x AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u)"""


def url_filter(rules) -> str:
    fits = [
        (len(host + path), f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')", host + path, action)
        for host, path, action in rules
    ]
    fits.sort(key=lambda f: (-f[0], f[2]))
    rule = " ".join(f"{when} THEN '{rule}'" for _, when, rule, _ in fits)
    action = " ".join(f"{when} THEN '{action}'" for _, when, _, action in fits)
    level = lambda name, groups, key, above, parent: f"""
{name}g AS (SELECT a.*, {above}.rate AS m FROM {groups} a JOIN {parent} {above} USING ({key})),
{name}c AS (SELECT coalesce({_STRENGTH}, 10) AS c FROM {name}g WHERE n > 0),
{name} AS (SELECT *, (k + c * m) / (n + c) AS rate, n + c AS total FROM {name}g, {name}c)"""  # noqa: E731
    return f"""WITH {_URL},
o AS (SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 WHEN quality = 1 OR toxic = 0 THEN 0 END) AS bad FROM labels GROUP BY 1),
h AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k FROM x LEFT JOIN o USING (page_id) GROUP BY 1),
hl AS (SELECT *, array_to_string(string_split(regexp_replace(host, ':[0-9]*$', ''), '.')[-2:], '.') AS domain,
              string_split(regexp_replace(host, ':[0-9]*$', ''), '.')[-1] AS suffix, 1 AS one FROM h),
base AS (SELECT 1 AS one, (coalesce(sum(k), 0) + 5) / (coalesce(sum(n), 0) + 10) AS rate FROM hl),
sg AS (SELECT suffix, 1 AS one, sum(n) AS n, sum(k) AS k FROM hl GROUP BY 1),
dg AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM hl GROUP BY 1, 2),
{level("sx", "sg", "one", "base0", "base")},
{level("dx", "dg", "suffix", "sx0", "sx")},
{level("hx", "hl", "suffix, domain", "dx0", "dx")},
v AS (SELECT host, CASE WHEN rate - 1.645 * sqrt(rate * (1 - rate) / (total + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS by_host FROM hx)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {action} ELSE by_host END AS verdict FROM x JOIN v USING (host)"""


LINES = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS key FROM l),
h AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY 1 HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, first_doc IS NOT NULL AND first_doc <> doc_id AS gone FROM k LEFT JOIN h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def vector_codes(parts: int, entries: int, rounds: int) -> str:
    """Codebook rounds over parts, one after the other."""
    # numbers are whole and small enough to be exact as doubles
    nearest = "min({'d': list_dot_product(x, x) - 2 * list_dot_product(x, y) + list_dot_product(y, y), 'e': entry})"
    steps = [
        f"""WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE {_USABLE}),
p AS MATERIALIZED (SELECT vec_id, label, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS x FROM k, (SELECT unnest(range({parts})) AS part)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS y FROM p QUALIFY entry < {entries})"""
    ]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT vec_id, label, part, any_value(x) AS x, {nearest} AS b FROM p JOIN c{i} USING (part) GROUP BY 1, 2, 3)")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT part, b.e AS entry, i, floor(sum(x[i + 1]) / count(*)) AS mean FROM a{i}, (SELECT unnest(range(len(x))) AS i FROM p LIMIT (SELECT max(len(x)) FROM p)) GROUP BY 1, 2, 3),
n{i} AS (SELECT part, entry, list(mean ORDER BY i) AS y FROM m{i} GROUP BY 1, 2),
c{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(n{i}.y, c{i}.y) AS y FROM c{i} LEFT JOIN n{i} USING (part, entry))""")
    steps.append(f"""r AS (SELECT vec_id, label, string_agg(printf('%02x', b.e), '' ORDER BY part) AS code, CAST(sum(b.d) AS BIGINT) AS error FROM a{rounds} GROUP BY 1, 2),
h AS (SELECT sha256(string_agg(array_to_string(list_transform(y, lambda z: CAST(z AS BIGINT)), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM r, h""")
    return ",\n".join(steps)


HARD_NEGATIVES = f"""
WITH k AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE label IS NOT NULL AND {_USABLE}),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
                   FROM k a JOIN k b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score QUALIFY rank <= 3"""
