"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from cartwright.llm import license_scan, quality_rules, url_filter


RULES = quality_rules.Rules()
VOCABULARY = quality_rules.vocabulary()
CLASSES = quality_rules.CLASSES


def _char_counts() -> str:
    """Lengths that each class takes off, in the order of the classes."""
    text, parts = "t", []
    for _, pattern in CLASSES:
        rest = f"regexp_replace({text}, '{pattern}', '', 'g')"
        parts.append(f"length({text}) - length({rest})")
        text = rest
    return ", ".join([*parts, f"length({text})"])


def _distance(histogram: str, reference: str) -> str:
    def part(x, m):
        return f"(CASE WHEN {x} > 0 THEN {x} * log2({x} / {m}) ELSE 0 END)"

    p, q = f"({histogram}[i] / CAST(list_sum({histogram}) AS DOUBLE))", f"({reference}[i])"
    mean = f"(({p} + {q}) / 2)"
    return (f"round(sqrt(greatest(list_sum(list_transform(range(1, len({histogram}) + 1), "
            f"lambda i: {part(p, mean)} + {part(q, mean)})) / 2, 0)), 6)")


def _shares(column: str, bins: int) -> str:
    counts = ", ".join(f"sum({column}[{i}]) + {RULES.smoothing}" for i in range(1, bins + 1))
    return f"[x / list_sum([{counts}]) FOR x IN [{counts}]]"


OP1 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM d
), hashed AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3] || ' ' || words[i + 4] AS w
  FROM windows
), counted AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM hashed
), starts AS (
  SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS prev FROM counted WHERE c > 1
), repeats AS (
  SELECT r, sum(least(5, coalesce(i - prev, 5))) AS n FROM starts GROUP BY r
), spread AS (
  SELECT r, lower(unnest(words)) AS w FROM d
), hits AS (
  SELECT r, {", ".join(f"count(*) FILTER (w = '{w}') AS h{i}" for i, w in enumerate(VOCABULARY))},
    count(*) FILTER (w NOT IN ({", ".join(f"'{w}'" for w in VOCABULARY)})) AS other
  FROM spread GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(t, chr(10))) AS line FROM d
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r
), m AS (
  SELECT d.r, doc_id, lang, length(t) AS n_chars, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '{quality_rules.SPACE}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
    [{_char_counts()}] AS chars,
    CASE WHEN hits.r IS NOT NULL THEN [{", ".join(f"h{i}" for i in range(len(VOCABULARY)))}, other] END AS common
  FROM d LEFT JOIN repeats USING (r) LEFT JOIN hits USING (r) LEFT JOIN dup USING (r)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
), refs AS (
  SELECT regexp_extract(lower(lang), '^([a-z]{{2,3}})([^a-z0-9]|$)', 1) AS code, {_shares("chars", quality_rules.CHAR_BINS)} AS char_ref,
    {_shares("common", len(VOCABULARY) + 1)} AS word_ref
  FROM judged WHERE NOT base_failed AND regexp_matches(lower(lang), '^[a-z]{{2,3}}([^a-z0-9]|$)') GROUP BY code
), far AS (
  SELECT r, min(CASE WHEN n_chars >= {RULES.char_guard} THEN {_distance("chars", "char_ref")} END) AS char_distance,
    min(CASE WHEN n_words >= {RULES.word_guard} THEN {_distance("common", "word_ref")} END) AS word_distance
  FROM judged CROSS JOIN refs GROUP BY r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance,
  NOT base_failed AND NOT coalesce(char_distance > {RULES.max_char_distance}, false)
    AND NOT coalesce(word_distance > {RULES.max_word_distance}, false) AS kept
FROM judged LEFT JOIN far USING (r)
"""

VOTES = license_scan.Votes()
N_PHRASES = len(license_scan.PHRASES)

OP5 = f"""
WITH names(template, label, n_pairs) AS (VALUES {", ".join(
    f"({i}, '{label}', {len(text.split()) - 1})"
    for i, (label, text) in enumerate(license_scan.PHRASES + license_scan.TEMPLATES))}),
pairs(template, tpos, pair) AS (VALUES {", ".join(f"({t}, {p}, '{g}')" for t, p, g in license_scan.template_pairs())}),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), words AS (
  SELECT r, unnest(range(0, len(words) - 1)) AS pos, words FROM d
), grams AS (
  SELECT r, pos, words[pos + 1] || ' ' || words[pos + 2] AS pair FROM words
), hits AS (
  SELECT r, template, tpos, pos FROM grams JOIN pairs USING (pair)
), diagonals AS (
  SELECT r, template, pos - tpos AS diagonal, list_distinct(list(tpos)) AS found, min(pos) AS lo, max(pos) AS hi
  FROM hits GROUP BY ALL
), kept AS (
  SELECT *, coalesce(template < {N_PHRASES} OR diagonal - lag(diagonal) OVER w > {VOTES.widest_step}, true) AS opens
  FROM diagonals JOIN names USING (template)
  WHERE CASE WHEN template < {N_PHRASES} THEN len(found) = n_pairs ELSE len(found) >= {VOTES.least_votes} END
  WINDOW w AS (PARTITION BY r, template ORDER BY diagonal)
), numbered AS (
  SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM kept
), spans AS (
  SELECT r, template, label, n_pairs, span, len(list_distinct(flatten(list(found)))) AS n, min(lo) AS lo, max(hi) AS hi
  FROM numbered GROUP BY ALL
), judged AS (
  SELECT *, template < {N_PHRASES} AS base, n / n_pairs >= {VOTES.least_share}
    AND hi - lo + 2 <= {VOTES.longest_span} * (n_pairs + 1) AS good
  FROM spans
), per_doc AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(lo) FILTER (base) AS first_word, max(lo) FILTER (base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label) FILTER (good)), ',') AS labels,
    max(n / n_pairs) FILTER (good) AS score
  FROM judged GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0.0), 6) AS score
FROM d LEFT JOIN per_doc USING (r)
"""


def _boundary(terms) -> str:
    return f"(?:^|[^\\pL\\pN])({'|'.join(terms)})(?:$|[^\\pL\\pN])"


OP7 = f"""
WITH lowered AS (
  SELECT page_id, translate(url, '{url_filter.UPPER}', '{url_filter.LOWER}') AS low,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, low,
    translate(regexp_extract(rest, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(coalesce(low, ''), '([^\\pL\\pN])', '\\1\\1', 'g') AS wide
  FROM lowered
), hits AS (
  SELECT *,
    CAST(len(regexp_extract_all(wide, '{_boundary(url_filter.STRICT)}')) AS INTEGER) AS n_strict,
    CAST(len(list_distinct(regexp_extract_all(wide, '{_boundary(url_filter.SOFT)}', 1))) AS INTEGER) AS n_soft
  FROM split
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/'
  END AS rule
  FROM hits
)
SELECT page_id, host, path, rule, n_strict, n_soft, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN n_strict > 0 OR n_soft >= 2 THEN 'block'
  ELSE 'allow' END AS verdict
FROM ruled
"""


def _crc32(text: str) -> str:
    """Checksum of an ASCII text, bit by bit per byte."""
    shift = "list_reduce(list_prepend({x}, range(8)), lambda c, _: xor(c >> 1, 3988292384 * (c & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    folded = f"list_reduce(list_prepend(4294967295, {codes}), lambda a, b: " + shift.format(x="xor(a, b)") + ")"
    return f"xor(4294967295, {folded})"


def _hashed(fields: list[str]) -> str:
    parts = [f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


#: levels of a tree that the SQL spells out: 8**7 leaves
LEVELS = 7


def _tree(name: str, leaves: str) -> str:
    """Tables ``name_0`` (from ``leaves``: grp, pos, h) to ``name_LEVELS`` with the nodes, their siblings and their run's size."""
    out = [f"{name}_0 AS MATERIALIZED ({leaves})"]
    for k in range(LEVELS):
        out.append(f"""{name}_{k + 1} AS MATERIALIZED (
  SELECT grp, pos // 8 AS pos, CASE WHEN max(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {name}_{k}) GROUP BY grp, pos // 8)""")
    return ",\n".join(out)


def _path(name: str, pos: str, grp: str) -> tuple[str, str]:
    """(joins, list of structs): the others of each run on the way up from a leaf, as text before and behind it."""
    joins, steps = [], []
    for k in range(LEVELS):
        at = f"({pos} // {8 ** k})"
        joins.append(f"""LEFT JOIN (SELECT a.grp, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r, max(a.n) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM {name}_{k}) a
  JOIN {name}_{k} b ON a.grp = b.grp AND a.pos // 8 = b.pos // 8 GROUP BY a.grp, a.pos) {name}_s{k}
  ON {name}_s{k}.grp = {grp} AND {name}_s{k}.pos = {at}""")
        steps.append(f"CASE WHEN {name}_s{k}.n > 1 THEN {{'l': {name}_s{k}.l, 'r': {name}_s{k}.r}} END")
    return "\n".join(joins), ", ".join(steps)


def _op12() -> str:
    names = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"]
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    own_joins, own_steps = _path("own", "x.pos", "x.grp")
    top_joins, top_steps = _path("top", "x.rank", "0")
    return f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS grp, {_hashed([*names, "text"])} AS leaf,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_hashed([*names, lower])} ELSE {_hashed([*names, "text"])} END AS found
  FROM documents
),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    dense_rank() OVER (ORDER BY grp) - 1 AS rank FROM d
),
{_tree("own", "SELECT grp, pos, leaf AS h FROM placed")},
{_tree("top", f"SELECT 0 AS grp, row_number() OVER (ORDER BY grp) - 1 AS pos, h FROM own_{LEVELS}")},
paths AS MATERIALIZED (
  SELECT x.doc_id, x.leaf, x.found, s.h AS subroot, t.h AS root, list_filter([{own_steps}, {top_steps}], lambda p: p IS NOT NULL) AS path
  FROM placed x JOIN own_{LEVELS} s USING (grp) CROSS JOIN top_{LEVELS} t
  {own_joins}
  {top_joins}
),
ended AS (
  SELECT *, list_reduce(list_prepend({{'l': found, 'r': ''}}, path), lambda a, p: {{'l': sha256(p.l || a.l || p.r), 'r': ''}}).l AS folded_root
  FROM paths
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(path, lambda p: p.l || p.r), ''), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM ended
"""


def _op13(k: int = 40, rounds: int = 5) -> str:
    mark = "sha256('2:' || CAST(vec_id AS VARCHAR))"
    steps = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x,
    row_number() OVER (ORDER BY {mark} NULLS LAST, embedding) - 1 AS place
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
c0 AS MATERIALIZED (SELECT CAST(place AS INTEGER) AS k, x AS c FROM v WHERE place < {k})"""]
    square = "list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT r, min({{'d': d, 'k': k}}) AS n FROM (SELECT r, k, CAST({square} AS BIGINT) AS d FROM v CROSS JOIN c{i}) GROUP BY r
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT k, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
    SELECT k, list(mean ORDER BY i) AS m FROM (
      SELECT n.k AS k, i, (sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS mean
      FROM near{i} JOIN v USING (r) CROSS JOIN (SELECT unnest(range(1, 65)) AS i) GROUP BY n.k, i)
    GROUP BY k) USING (k)
)""")
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, n.k AS cluster, n.d AS distance, CAST(sum(n.d) OVER (PARTITION BY n.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(n.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near{rounds} JOIN v USING (r) JOIN c{rounds} ON c{rounds}.k = n.k
"""


def statements() -> dict[str, str]:
    return {"op1_quality_rules": OP1, "op5_license_scan": OP5, "op7_url_filter": OP7, "op12_merkle": _op12(), "op13_sharded_lloyd": _op13()}
