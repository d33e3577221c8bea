"""DuckDB SQL for the results that SQL can state."""

from __future__ import annotations

#: Host, path and node of an address, as in the contract of the URL filter.
_HOST = "translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_REST = "coalesce(CASE WHEN instr({0}, '://') > 0 THEN substr({0}, instr({0}, '://') + 3) END, '')"

_URL_RULES = """rules(rule, rule_host, rule_path, action) AS (VALUES ('net/', 'net', '/', 'block'),
 ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'),
 ('org/fr/', 'org', '/fr/', 'allow'))"""


def _ruled(name: str, source: str, key: str) -> str:
    return f"""{name} AS (SELECT {key}, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
 FROM {source} JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
 GROUP BY {key})"""


# Links are read with one pattern per tag; double quotes only, as the pages write them.
_OP1 = f"""WITH RECURSIVE {_URL_RULES},
p AS (SELECT page_id, host, path, CASE WHEN host <> '' THEN host || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) END AS node, url, html
 FROM (SELECT *, {_HOST} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM (
  SELECT page_id, url, html, {_REST.format('url')} AS rest FROM pages))),
l AS (SELECT node AS a, {_REST.format('t')} AS rest FROM (
 SELECT node, regexp_extract(html, '<link rel="canonical" href="([^"]*)"', 1) AS t FROM p) WHERE node IS NOT NULL AND t <> ''),
e AS (SELECT a, {_HOST} || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS b FROM l WHERE rest <> ''),
b AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(n, m) AS (SELECT a, a FROM b UNION SELECT r.n, b.b FROM r JOIN b ON r.m = b.a),
m AS (SELECT DISTINCT n, m, regexp_extract(m, '^[^/?#]*') AS host, regexp_extract(m, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
{_ruled('mr', 'm', 'm')}, {_ruled('pr', 'p', 'page_id')},
c AS (SELECT n, bool_or(action = 'allow') AS a, bool_or(action = 'block') AS b FROM m LEFT JOIN mr USING (m) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN a THEN 'allow' WHEN b THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN pr USING (page_id) LEFT JOIN c ON node = n"""

_BENCH_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP5 = f"""WITH i AS (SELECT DISTINCT item_id::VARCHAR AS item, {_BENCH_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item, least(13, len(w)) AS k, array_to_string(w[j:j + least(13, len(w)) - 1], ' ') AS s
 FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS j FROM i WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_BENCH_WORDS}, []) AS w FROM documents),
k AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT r, j, k, array_to_string(w[j:j + k - 1], ' ') AS s
 FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM d, k WHERE len(w) >= k)),
h AS (SELECT r, j, k, item FROM dw JOIN iw USING (k, s)),
p AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest(range(j, j + k)) AS x FROM (SELECT DISTINCT r, j, k FROM h)) GROUP BY r),
t AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(p.n, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, coalesce(p.n, 0) > 0 AND 20 * coalesce(p.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)"""

# Levels are filled source by source, as in the operator; positions use the closed form of a straight line.
_OP9 = r"""WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
k AS (SELECT *, md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || size) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(place % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
v AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
c AS (SELECT arg_min(level, (cap / weight, place)) FILTER (level * weight <= cap) AS level FROM v),
t AS (SELECT source, source_size, place, CASE WHEN v.level * weight <= cap THEN least(cap, c.level * weight) ELSE cap END AS target FROM v, c),
p AS (SELECT k.*, source_size, target, place, (sum(size) OVER (PARTITION BY k.source ORDER BY key ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
 FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, greatest(0, least(size, round(target)::BIGINT - start)) + greatest(0, least(size, round(target)::BIGINT - start - source_size)) AS taken,
 start / target AS x, CASE place % 3 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 0.5::DOUBLE ELSE -0.5::DOUBLE END AS a FROM p)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
 CASE WHEN taken > 0 THEN round(2 * x / ((1 - a) + sqrt(greatest(0.0::DOUBLE, (1 - a) * (1 - a) + 4 * a * x))), 9) END AS position FROM q"""

_SECRET_KINDS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1), ("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15)]


def _span_rows(kind: str, pattern: str, group: int, least: int, nth: int) -> str:
    """Places of the matches of one kind: what precedes them is split off and added up."""
    return f"""SELECT r, {nth} AS nth, '{kind}' AS kind, e - len(m) AS b, e FROM (
 SELECT r, m, g, sum(len(p) + len(m)) OVER (PARTITION BY r ORDER BY i) AS e FROM (
  SELECT r, unnest(m) AS m, unnest(g) AS g, unnest(p[:len(m)]) AS p, generate_subscripts(m, 1) AS i FROM (
   SELECT r, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS g, regexp_split_to_array(t, '{pattern}') AS p FROM d)))
 WHERE len(g) >= {least}"""


_OP6 = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_span_rows(*k, n) for n, k in enumerate(_SECRET_KINDS))}),
a AS (SELECT r, count(*) FILTER (nth = 0) AS n_assign, count(*) FILTER (nth = 1) AS n_access, count(*) FILTER (nth = 2) AS n_hex,
 string_agg(kind || ':' || b::BIGINT || ':' || e::BIGINT, ',' ORDER BY b, nth) FILTER (nth < 3) AS base,
 string_agg(kind || ':' || b::BIGINT || ':' || e::BIGINT, ',' ORDER BY b, nth) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
 sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (r)"""

_OP7 = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT r, source, t, x, i, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n,
 lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))) AS k
 FROM (SELECT r, source, t, unnest(string_split(t, chr(10))) AS x, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d)),
f AS (SELECT * FROM l WHERE n > 0),
dup AS (SELECT r, count(*) - count(DISTINCT x) AS n_dup_lines FROM f GROUP BY r),
win AS (SELECT r, j, array_to_string(w[j:j + 7], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS j FROM d WHERE len(w) >= 8)),
rep AS (SELECT r, count(DISTINCT x) AS n_repeat_words FROM (SELECT r, unnest(range(j, j + 8)) AS x FROM win
 JOIN (SELECT r, s FROM win GROUP BY r, s HAVING count(*) > 1) USING (r, s)) GROUP BY r),
frq AS (SELECT source, k FROM f GROUP BY source, k HAVING count(DISTINCT t) >= 20 AND 100 * count(DISTINCT t) > 5 * (
 SELECT count(DISTINCT t) FROM d WHERE d.source IS NOT DISTINCT FROM f.source)),
rem AS (SELECT r, sum(n)::BIGINT AS n_removed FROM f JOIN frq ON f.source IS NOT DISTINCT FROM frq.source AND f.k = frq.k GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
 len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
 coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_removed, 0) AS n_removed
 FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN rem USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND NOT (n_removed > 0 AND (2 * n_removed > n_words OR n_words - n_removed < 20)) AS kept FROM b"""

def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text: a byte is mixed in, then eight steps follow (marked by -1)."""
    steps = f"flatten([list_concat([ascii(c)], [-1, -1, -1, -1, -1, -1, -1, -1]) for c in string_split({text}, '')])"
    return (
        f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)"
        " ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295::BIGINT)")


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)]
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, levels: int, first: str) -> str:
    """CTEs name0 (given: t, i, n, d) to name{levels}: one row per node; name_g{k}: nodes with the digests of their run."""
    out = [f"{name}0 AS ({first})"]
    for k in range(levels):
        out.append(
            f"{name}_g{k} AS (SELECT t, i, d, list(d) OVER (PARTITION BY t, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING"
            f" AND UNBOUNDED FOLLOWING) AS run FROM {name}{k} WHERE n > 1)")
        out.append(
            f"{name}{k + 1} AS (SELECT t, i // 16 AS i, (n + 15) // 16 AS n, sha256(string_agg(d, '' ORDER BY i)) AS d FROM {name}{k}"
            f" WHERE n > 1 GROUP BY t, i // 16, n UNION ALL SELECT t, i, n, d FROM {name}{k} WHERE n = 1)")
    return ",\n".join(out)


def _folded(name: str, levels: int, first: str, tree: str, place: str) -> str:
    """CTEs that take rows with (proof, folded) through the levels of a tree; name_f{levels} is the result."""
    out, before = [], first
    for k in range(levels):
        at = f"{place} // {16 ** k}"
        left, right = f"array_to_string(run[:({at}) % 16], '')", f"array_to_string(run[({at}) % 16 + 2:], '')"
        out.append(
            f"{name}_f{k + 1} AS (SELECT f.* REPLACE (CASE WHEN g.t IS NULL THEN proof ELSE proof || {left} || {right} END AS proof,"
            f" CASE WHEN g.t IS NULL THEN folded ELSE sha256({left} || folded || {right}) END AS folded)"
            f" FROM {before} f LEFT JOIN {name}_g{k} g ON g.t = {tree} AND g.i = {at})")
        before = f"{name}_f{k + 1}"
    return ",\n".join(out)


# Trees of up to 16^5 leaves and 16^3 sources; a tree that is done passes through the rest.
_LOWERED = f"CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
_OP13 = f"""WITH s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS t FROM (SELECT DISTINCT source FROM documents)),
b AS (SELECT doc_id, source, {_leaf('text')} AS leaf, {_leaf('changed')} AS given FROM (SELECT *, {_LOWERED} AS changed FROM documents)),
d AS (SELECT doc_id, leaf, given, t, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
 count(*) OVER (PARTITION BY t) AS n FROM b JOIN s ON b.source IS NOT DISTINCT FROM s.source),
{_tree('l', 5, 'SELECT t, i, n, leaf AS d FROM d')},
{_tree('u', 3, 'SELECT 0 AS t, l5.t AS i, (SELECT count(*) FROM s) AS n, d FROM l5')},
f AS (SELECT *, '' AS proof, given AS folded FROM d),
{_folded('l', 5, 'f', 'f.t', 'f.i')},
{_folded('u', 3, 'l_f5', '0', 'f.t')}
SELECT doc_id, leaf, l5.d AS subroot, u3.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = u3.d AS verified
FROM u_f3 x JOIN l5 ON l5.t = x.t, u3"""


SQL = {"op6_secret_scan": _OP6, "op7_quality_rules": _OP7, "op9_source_mixing": _OP9, "op1_url_filter": _OP1, "op5_decontamination": _OP5, "op13_merkle_manifest": _OP13}
