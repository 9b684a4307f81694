"""DuckDB SQL for the queries that SQL can express."""

EXACT_DEDUP = """
WITH digests AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)
"""

MIXING = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, sqrt(n::DOUBLE) / sum(sqrt(n::DOUBLE)) OVER () * (SELECT count(*) FROM documents)::DOUBLE / n AS rate FROM counts
),
steps AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM (SELECT source, rate, unnest(range(0, (ceil(rate + 10 * sqrt(rate)) + 21)::BIGINT)) AS k FROM rates)
),
drawn AS (
  SELECT d.doc_id, any_value(d.source) AS source, any_value(d.text) AS text, count(s.k) AS copies
  FROM (SELECT *, ('0x' || substr(md5('42|count|' || doc_id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM documents) d
  JOIN steps s ON s.source = d.source AND s.cdf <= d.u
  GROUP BY d.doc_id
)
SELECT doc_id, source, copy, copies, md5('42|order|' || doc_id || '|' || copy) AS order_key, sha256(coalesce(text, '')) AS text_sha256
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM drawn)
"""

JACCARD_JOIN = """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w
  FROM documents
),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 5 THEN array_to_string(w[i:i + 4], ' ') ELSE array_to_string(w, ' ') END AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
linked AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a AS u, b AS v FROM linked UNION ALL SELECT b, a FROM linked),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.v FROM reach r JOIN edges e ON e.u = r.other)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""


def _found(name: str, pattern: str, group: int, least: int, table: str = "texts", key: str = "doc_id") -> str:
    """Matches of one kind with their places: what lies between matches and the matches alternate."""
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
{name}_parts AS (SELECT {key}, x, string_split_regex(x, {quoted}) AS g, regexp_extract_all(x, {quoted}, 0) AS m, regexp_extract_all(x, {quoted}, {group}) AS v FROM {table} WHERE regexp_matches(x, {quoted})),
{name}_at AS (SELECT {key}, g, m, v, unnest(range(1, len(m) + 1)) AS i FROM {name}_parts),
{name}_spans AS (
  SELECT {key}, m[i] AS hit, (list_sum(list_transform(g[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda p: length(p))), 0))::BIGINT AS s, length(m[i]) AS n
  FROM {name}_at WHERE length(v[i]) >= {least}
)"""


def secret_scan() -> str:
    from textloom.llm import secret_scan as op

    encodings = [(pattern, alphabet) for _, pattern, alphabet in op.ENCODINGS]
    alphabet = "CASE " + " ".join(f"WHEN regexp_matches(bare, '{pattern}') THEN '{letters}'" for pattern, letters in encodings) + " END"
    bins = ", ".join(f"count(*) FILTER (v * {op.BINS} // k = {b}) AS c{b}" for b in range(op.BINS))
    sizes = lambda b: "CASE k " + " ".join(f"WHEN {k} THEN {sum(v * op.BINS // k == b for v in range(k))}" for k in sorted({len(a) for _, a in encodings})) + " END"
    expected = lambda b: f"(n * ({sizes(b)} / k::DOUBLE))"
    half = "(" + " + ".join(f"(c{b} - {expected(b)}) * (c{b} - {expected(b)}) / {expected(b)}" for b in range(op.BINS)) + ") / 2"

    def two_sided(z: str) -> str:
        x = f"(abs({z}) / sqrt(2.0::DOUBLE))"
        t = f"(1.0::DOUBLE / (1.0 + 0.3275911::DOUBLE * {x}))"
        return f"({t} * (0.254829592::DOUBLE + {t} * (-0.284496736::DOUBLE + {t} * (1.421413741::DOUBLE + {t} * (-1.453152027::DOUBLE + {t} * 1.061405429::DOUBLE)))) * exp(-{x} * {x}))"

    kinds = [("assign", op.ASSIGN, 2, op.ASSIGN_LEAST), ("access", op.ACCESS, 0, op.ACCESS_LEAST), ("hex", op.HEX, 0, 0)]
    grid = f"unnest(range(1, {op.GRID // 2 + 1}))"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
{",".join(_found(*kind) for kind in [*kinds, ("piece", op.PIECE, 0, 0)])},
mixed AS MATERIALIZED (SELECT row_number() OVER () AS piece, doc_id, s AS at, hit AS x FROM piece_spans WHERE regexp_matches(hit, '[+/]') AND regexp_matches(hit, '[_-]')),
{",".join(_found(f"part{k}", pattern, 0, 0, "mixed", "piece") for k, pattern in enumerate(op.PARTS))},
tokens AS (
  SELECT doc_id, s, n, hit FROM piece_spans WHERE NOT (regexp_matches(hit, '[+/]') AND regexp_matches(hit, '[_-]'))
  UNION ALL SELECT DISTINCT m.doc_id, m.at + p.s, p.n, p.hit FROM ({" UNION ALL ".join(f"SELECT * FROM part{k}_spans" for k in range(len(op.PARTS)))}) p JOIN mixed m ON m.piece = p.piece
),
base AS ({" UNION ALL ".join(f"SELECT doc_id, {i} AS kind, s, s + n AS e FROM {name}_spans" for i, (name, *_) in enumerate(kinds))}),
free AS (SELECT t.doc_id, t.s, t.s + t.n AS e, t.n AS length, regexp_replace(t.hit, '=+$', '') AS bare FROM tokens t WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = t.doc_id AND b.s < t.s + t.n AND t.s < b.e)),
coded AS (SELECT *, {alphabet} AS letters FROM free WHERE length(bare) >= 20),
symbols AS (SELECT doc_id, s, e, length, length(letters) AS k, i, strpos(letters, bare[i:i]) - 1 AS v FROM (SELECT *, unnest(range(1, length(bare) + 1)) AS i FROM coded WHERE letters IS NOT NULL)),
lagged AS (SELECT *, lag(v) OVER (PARTITION BY doc_id, s, e ORDER BY i) AS u FROM symbols),
sums AS (
  SELECT doc_id, s, e, length, k, count(*) AS n, {bins}, count(*) FILTER ((u * 2 >= k) <> (v * 2 >= k)) AS turns, coalesce(sum((u - (k - 1) / 2.0::DOUBLE) * (v - (k - 1) / 2.0::DOUBLE)), 0) AS serial
  FROM lagged GROUP BY doc_id, s, e, length, k
),
tests AS (
  SELECT doc_id, s, e, floor(2 * log2(length / 20.0::DOUBLE))::INT AS class, exp(-{half}) * (1 + {half}) AS chi,
    {two_sided("((turns - (n - 1) / 2.0::DOUBLE) / sqrt((n - 1) / 4.0::DOUBLE))")} AS runs, {two_sided("(serial / ((k * k - 1) / 12.0::DOUBLE) / sqrt(n - 1))")} AS correlated
  FROM sums
),
scored AS (SELECT doc_id, s, e, class, 1 - pow(1 - least(chi, runs, correlated, 1.0), 3.0) AS p FROM tests),
cells AS (SELECT class, least(floor(p * {op.GRID}), {op.GRID - 1})::INT AS cell FROM scored),
classes AS (SELECT class, least(2.0 * count(*) FILTER (cell >= {op.GRID // 2}), count(*)::DOUBLE) AS random FROM cells GROUP BY class),
steps AS (SELECT class, random, {grid} AS step FROM classes),
rates AS (SELECT t.class, t.step, t.random, count(c.cell) AS found FROM steps t LEFT JOIN cells c ON c.class = t.class AND c.cell >= t.step GROUP BY t.class, t.step, t.random),
limits AS (SELECT class, coalesce(min(step) FILTER (found > 0 AND greatest(0.0, found - random * (1 - step / {float(op.GRID)}::DOUBLE)) <= {op.FALSE_DISCOVERY_RATE} * found) / {float(op.GRID)}::DOUBLE, 0.5) AS least_p FROM rates GROUP BY class),
random AS (SELECT DISTINCT s.doc_id, s.s, s.e FROM scored s JOIN limits l ON l.class = s.class WHERE s.p >= greatest({op.LEAST_THRESHOLD}, l.least_p)),
everything AS (SELECT * FROM base UNION ALL SELECT r.doc_id, 3, r.s, r.e FROM random r WHERE NOT EXISTS (SELECT 1 FROM random o WHERE o.doc_id = r.doc_id AND (o.s, o.e) <> (r.s, r.e) AND o.s <= r.s AND r.e <= o.e)),
named AS (SELECT *, (['assign', 'access', 'hex', 'random'])[kind + 1] || ':' || s || ':' || e AS span FROM everything)
SELECT t.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY s, kind) FILTER (kind < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY s, kind), '') AS spans, count(*) FILTER (kind = 3) AS n_random
FROM documents t LEFT JOIN named n ON n.doc_id = t.doc_id GROUP BY t.doc_id
"""


def vector_codes() -> str:
    from textloom.llm import vector_codes as op

    def assigned(k: int) -> str:
        gap = "list_sum(list_transform(list_zip(q.x, c.x), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"
        return f"a{k} AS MATERIALIZED (SELECT q.rid, q.p, any_value(q.x) AS x, min({gap}::HUGEINT * {op.ENTRIES} + c.e) AS best FROM parts q JOIN c{k} c ON c.p = q.p GROUP BY q.rid, q.p)"

    def moved(k: int) -> str:
        return f"""
m{k} AS (SELECT p, e, i, sum(x[i])::HUGEINT AS s, count(*) AS n FROM (SELECT p, (best % {op.ENTRIES})::INT AS e, x, unnest(range(1, len(x) + 1)) AS i FROM a{k}) GROUP BY p, e, i),
f{k} AS (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM m{k} GROUP BY p, e),
c{k + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(f.x, c.x) AS x FROM c{k} c LEFT JOIN f{k} f ON f.p = c.p AND f.e = c.e)"""

    rounds = ",\n".join(f"{assigned(k)},{moved(k)}" for k in range(op.ROUNDS))
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({op.SCALE} * x::DOUBLE)::BIGINT) AS x, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rid
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS MATERIALIZED (SELECT rid, p, x[p * (len(x) // {op.PARTS}) + 1:(p + 1) * (len(x) // {op.PARTS})] AS x FROM (SELECT rid, x, unnest(range(0, {op.PARTS})) AS p FROM kept)),
c0 AS MATERIALIZED (SELECT p, rid AS e, x FROM parts WHERE rid < {op.ENTRIES}),
{rounds},
{assigned(op.ROUNDS)},
coded AS (SELECT rid, string_agg(lpad(lower(hex((best % {op.ENTRIES})::INT)), 2, '0'), '' ORDER BY p) AS code, sum(best // {op.ENTRIES})::BIGINT AS error FROM a{op.ROUNDS} GROUP BY rid),
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS digest FROM c{op.ROUNDS})
SELECT k.vec_id, k.label, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, b.digest AS codebooks_sha256
FROM kept k JOIN coded c ON c.rid = k.rid CROSS JOIN books b
"""


def prefix_trie() -> str:
    from textloom.llm import prefix_trie as op

    byte = "CASE WHEN op >= 0 THEN xor(crc, op) ELSE crc END"  # a step a bit, the first of each byte takes it in
    steps = "flatten(list_transform(range(1, length(c) + 1), lambda i: [ascii(c[i:i])::BIGINT, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce({steps}, lambda crc, op: xor(({byte}) >> 1, 3988292384 * (({byte}) & 1)), 4294967295::BIGINT), 4294967295)"
    return f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT conv_id, conv_id::VARCHAR AS c, list(x ORDER BY i) AS own FROM turns GROUP BY conv_id),
heads AS (SELECT *, (({crc}) % {op.SHARED_TURNS})::INT AS h FROM convs),
rebuilt AS (SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS path FROM heads c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % {op.GROUP}),
passed AS (SELECT conv_id, d, path[1:d] AS k, d = len(path) AS last FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)),
nodes AS MATERIALIZED (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '') AS ends FROM passed GROUP BY d, k),
kids AS MATERIALIZED (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
valued AS MATERIALIZED (SELECT n.*, coalesce(c.n, 0) AS n_children, CASE WHEN n.d > 0 THEN (n.n_convs - 1) * length(n.k[n.d].text) ELSE 0 END AS saved FROM nodes n LEFT JOIN kids c ON c.d = n.d AND c.k = n.k),
sums AS (
  SELECT d, k, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT u.saved, u.n_children, unnest(range(0, u.d + 1)) AS d, u.k AS whole FROM valued u) CROSS JOIN LATERAL (SELECT whole[1:d] AS k) GROUP BY d, k
)
SELECT v.conv_id, v.d::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN sums s ON s.d = v.d AND s.k = v.k LEFT JOIN nodes p ON p.d = v.d - 1 AND p.k = v.k[1:v.d - 1]
"""
