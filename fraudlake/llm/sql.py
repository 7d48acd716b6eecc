"""DuckDB SQL that checks the queries of this folder which SQL can express."""

from fraudlake.llm.licences import TEMPLATES
from fraudlake.llm.secret_scan import BASE_RULES, RULES

TOP_K = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _url_verdicts(depth: int = 6) -> str:
    """The template tree with its levels written out, one common table expression a step."""
    ctes = ["""
w AS (
  SELECT doc_id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS label
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id
)""", """
u AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
         try_cast(regexp_extract(url, '://[^/?#]*/[^?#]*?([0-9]+)[^0-9/?#]*/?([?#]|$)', 1) AS BIGINT) AS doc_id
  FROM pages
)""", """
h AS (
  SELECT page_id, w.label, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u LEFT JOIN w USING (doc_id)
)""", f"""
r0 AS (
  SELECT *, '' AS node, CASE WHEN len(s) > {depth} THEN list_append(s[1:{depth - 1}], array_to_string(s[{depth}:], '/')) ELSE s END AS segs
  FROM (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS s FROM h)
)"""]
    for d in range(1, depth + 1):
        p = d - 1
        ctes.append(f"k{d} AS (SELECT host, node, segs[{d}] AS seg, count(*) AS n FROM r{p} WHERE len(segs) >= {d} GROUP BY ALL)")
        ctes.append(f"""
r{d} AS (
  SELECT r.page_id, r.label, r.host, r.path, r.segs,
         r.node || CASE WHEN k.seg IS NULL THEN '' WHEN (k.kinds > 16 AND k.total < 20 * k.kinds OR regexp_matches(k.seg, '[0-9]')) AND NOT (k.n >= 50 AND k.n >= 0.01 * k.total) THEN '/*' ELSE '/' || k.seg END AS node
  FROM r{p} r LEFT JOIN (SELECT *, sum(n) OVER v AS total, count(*) OVER v AS kinds FROM k{d} WINDOW v AS (PARTITION BY host, node)) k
    ON r.host = k.host AND r.node = k.node AND r.segs[{d}] = k.seg
)""")
    ctes.append(f"m{depth + 1} AS (SELECT host, node, node AS final, count(label) AS labelled, coalesce(sum(label), 0) AS good FROM r{depth} GROUP BY host, node)")
    for d in range(depth, 0, -1):
        ctes.append(f"""
f{d} AS (
  SELECT *, CASE WHEN len(string_split(final, '/')) > {d} THEN
           array_to_string(list_concat(list_append(string_split(final, '/')[1:{d}], '*'), string_split(final, '/')[{d + 2}:]), '/') END AS family
  FROM m{d + 1}
)""")
        ctes.append(f"""
g{d} AS (
  SELECT *, sum(l) OVER v AS al, sum(g) OVER v AS ag, count(*) OVER v AS nodes
  FROM (SELECT host, family, final, sum(labelled) AS l, sum(good) AS g FROM f{d} WHERE family IS NOT NULL GROUP BY ALL)
  WINDOW v AS (PARTITION BY host, family)
)""")
        ctes.append(f"""
m{d} AS (
  SELECT f.host, f.node, f.labelled, f.good,
         CASE WHEN g.nodes > 1 AND (l = 0 OR al = l OR
                power(g / greatest(l, 1) - (ag - g) / greatest(al - l, 1), 2)
                <= 1.96 * 1.96 * (ag / greatest(al, 1)) * (1 - ag / greatest(al, 1)) * (1.0 / greatest(l, 1) + 1.0 / greatest(al - l, 1)))
              THEN f.family ELSE f.final END AS final
  FROM f{d} f LEFT JOIN g{d} g ON f.host = g.host AND f.final = g.final AND f.family = g.family
)""")
    ctes.append("""
t AS (
  SELECT host, node, final,
         (sum(good) OVER v + 10.0 * coalesce((SELECT sum(good) / nullif(sum(labelled), 0) FROM m1), 1)) / (sum(labelled) OVER v + 10.0) AS purity
  FROM m1 WINDOW v AS (PARTITION BY host, final)
)""")
    ctes.append(f"""
x AS (
  SELECT r.*, t.purity, t.final,
         CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
              WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
  FROM r{depth} r JOIN t USING (host, node)
)""")
    return "WITH " + ",".join(ctes) + """
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN purity >= 0.5 THEN 'allow' ELSE 'block' END AS verdict,
       host || final AS template, CAST(round(purity, 9) AS DOUBLE) AS purity
FROM x
"""


URL_VERDICTS = _url_verdicts()


def _licence_scan() -> str:
    """Segments and template-sized windows as lists of words; windows only where enough bigrams hit."""
    grams = "list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1])"
    words = "list_transform(regexp_extract_all(lower({t}), '[a-z0-9]+'), lambda x: CASE WHEN regexp_full_match(x, '[0-9]{{3,}}') THEN '#' ELSE x END)"
    quoted = ", ".join("('{}', '{}', {})".format(t.name, t.text.replace("'", "''"), f"{list(t.must)}::VARCHAR[]") for t in TEMPLATES)
    return f"""
WITH lt AS (
  SELECT row_number() OVER () AS t, k, must, len(w) AS l, list_distinct({grams.format(w="w")}) AS g
  FROM (SELECT k, must, {words.format(t="x")} AS w FROM (VALUES {quoted}) v(k, x, must))
), tg AS (SELECT t, l, len(g) AS m, unnest(g) AS gram FROM lt),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
seg AS (
  SELECT r, unnest(string_split(text, chr(10))) AS s, true AS is_line FROM d
  UNION ALL SELECT r, unnest(string_split(text, chr(10) || chr(10))), false FROM d
  UNION ALL SELECT r, text, false FROM d
), sw AS (SELECT row_number() OVER () AS n, r, is_line, w FROM (SELECT r, is_line, {words.format(t="s")} AS w FROM seg) WHERE len(w) > 1),
sg AS (SELECT n, unnest(list_distinct({grams.format(w="w")})) AS gram FROM sw),
sc AS (SELECT n, t FROM sg JOIN tg USING (gram) GROUP BY n, t, m HAVING count(*) >= 0.8 / 1.2 * m - 0.000001),
dw AS (SELECT r, {words.format(t="text")} AS w FROM d),
p AS (SELECT r, unnest({grams.format(w="w")}) AS gram, unnest(range(1, len(w))) AS i FROM dw),
hit AS (SELECT r, i, t, l, m FROM p JOIN tg USING (gram)),
near AS (
  SELECT r, i, t, l FROM (
    SELECT *, count(*) OVER (PARTITION BY r, t ORDER BY i RANGE BETWEEN CURRENT ROW AND l - 2 FOLLOWING) AS n FROM hit)
  WHERE n >= 0.8 / 1.2 * m - 0.000001
), a AS (
  SELECT r, n, is_line, t, w FROM sc JOIN sw USING (n)
  UNION ALL SELECT r, 0, false, t, w[i:i + l - 1] FROM near JOIN dw USING (r)
), x AS (SELECT *, list_distinct({grams.format(w="w")}) AS own FROM a),
f AS (
  SELECT x.r, x.n, is_line, k, l, 2.0 * len(list_intersect(own, g)) / (len(own) + len(g)) AS dice
  FROM x JOIN lt USING (t) WHERE list_has_all(w, must)
), ok AS (SELECT * FROM f WHERE dice >= 0.8),
best AS (
  SELECT r, k AS license_id, dice FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY dice DESC, l DESC, k) AS o FROM ok) WHERE o = 1
), n AS (SELECT r, count(DISTINCT n) AS n FROM ok WHERE is_line GROUP BY r)
SELECT doc_id, license_id, CAST(coalesce(dice, 0) AS DOUBLE) AS dice, CAST(coalesce(n.n, 0) AS BIGINT) AS line_matches
FROM d LEFT JOIN best USING (r) LEFT JOIN n USING (r)
"""


LICENCE_SCAN = _licence_scan()


def either_case(pattern: str) -> str:
    """``pattern`` with each ASCII letter outside classes and escapes as a class of both cases."""
    out, depth, at = [], 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            n = 4 if pattern[at + 1] == "x" else 2
            out.append(pattern[at : at + n])
            at += n
            continue
        depth += (c == "[") - (c == "]")
        out.append(f"[{c.upper()}{c.lower()}]" if not depth and c.isascii() and c.isalpha() else c)
        at += 1
    return "".join(out)


def _secret_scan() -> str:
    """Matches by extraction, their places from the lengths of the matches and of what lies between."""
    found = []
    for n, r in enumerate(RULES):
        p = (either_case(r.pattern) if r.any_case else r.pattern).replace("'", "''")
        found.append(f"""
SELECT r, {n} AS k, '{r.kind}' AS kind, i, len(m[i]) AS n, len(g[i]) AS own, len(s[i]) AS gap, {r.least} AS least FROM (
  SELECT r, m, g, s, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT r, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {r.group}) AS g, regexp_split_to_array(t, '{p}') AS s FROM d))""")
    base = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in BASE_RULES)
    listed = "string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, k)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(found)}),
p AS (SELECT *, CAST(sum(gap + n) OVER (PARTITION BY r, k ORDER BY i) - n AS BIGINT) AS b FROM f),
a AS (SELECT r, {counts}, {listed} FILTER (kind IN ({base})) AS own, {listed} AS spans FROM p WHERE own >= least GROUP BY r)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
       sha256(coalesce(a.own, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)
"""


SECRET_SCAN = _secret_scan()

HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.e, c.e), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def _crc_table() -> list[int]:
    """The 256 steps of the common CRC-32 (reversed polynomial 0xEDB88320)."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


TARGET_RESAMPLING = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
w AS (
  SELECT r, raw, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM (SELECT r, true AS raw, coalesce(text, '') AS t FROM docs UNION ALL SELECT NULL, false, coalesce(text, '') FROM benchmark)
), f AS (
  SELECT r, raw, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM w
), h AS (SELECT f, hex(encode(f)) AS x FROM f GROUP BY f),
b AS (
  SELECT f, xor(list_reduce(list_transform(range(0, len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)),
           lambda c, y: xor({_crc_table()}[1 + (xor(c, y) & 255)], c >> 8), 4294967295), 4294967295) % 10000 AS b
  FROM h
), n AS (SELECT b, count(*) FILTER (raw) AS s, count(*) FILTER (NOT raw) AS t FROM f JOIN b USING (f) GROUP BY b),
a AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM n),
g AS (SELECT n.b, CAST(floor(1000 * ln((n.t + 1) * (a.s + 10000) / ((n.s + 1) * (a.t + 10000)))) AS BIGINT) AS g FROM n, a),
d AS (SELECT r, count(*) AS n, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight FROM f JOIN b USING (f) JOIN g USING (b) WHERE raw GROUP BY r),
e AS (
  SELECT docs.r, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), sha256(coalesce(text, '')))), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN d USING (r)
), o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 39 ORDER BY score DESC, doc_id NULLS FIRST, r) AS o, count(*) OVER (PARTITION BY n_features >= 39) AS m FROM e)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN n_features >= 39 AND o <= 25 * m // 100 THEN o END AS BIGINT) AS rank FROM o
"""
