"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from voltgrid.llm import mixing, pivots, prefix_trie, quality, sharding

# RE2 and Java spell the five controls and the blank alike.
SPACE = r"[\x20\x09-\x0D]+"
WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '')"


def mixing_sql() -> str:
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return f"""
WITH sized AS (SELECT doc_id, source, text, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS s,
               row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS r FROM sized GROUP BY source),
weighed AS (SELECT *, [{weights}][CAST(r % {len(mixing.WEIGHTS)} AS INT) + 1] AS w, {mixing.CAP} * s AS c FROM per),
levels AS (SELECT *, ({mixing.SHARE} * (SELECT sum(s) FROM per)
    - coalesce(sum(c) OVER (ORDER BY c / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / ((SELECT sum(w) FROM weighed)
    - coalesce(sum(w) OVER (ORDER BY c / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS l
    FROM weighed),
targets AS (SELECT source, s, least(c, w * (SELECT max(l) FROM levels)) AS target FROM levels),
rates AS (SELECT *, CASE WHEN s > 0 THEN target / s ELSE 0 END AS rate FROM targets)
SELECT d.doc_id, d.size, t.s AS source_size, CAST(t.target AS DOUBLE) AS target,
  CAST(d.size * k.copies AS BIGINT) AS taken, k.copies
FROM sized d JOIN rates t ON d.source IS NOT DISTINCT FROM t.source,
LATERAL (SELECT CAST(floor(t.rate) AS BIGINT) + CASE WHEN
  CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), md5(coalesce(d.text, '')))), 1, 13)
       AS BIGINT) / 4503599627370496.0 < t.rate - floor(t.rate) THEN 1 ELSE 0 END AS copies) k"""


def sharding_sql(source: str = "documents", row: str = "doc_id") -> str:
    n, m = sharding.SHARDS, sharding.TABLE_SIZE
    h = lambda x: f"CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT)"
    return f"""
WITH RECURSIVE shards AS (
  SELECT list({h("name || ':offset'")} % {m} ORDER BY i) AS o, list({h("name || ':skip'")} % {m - 1} + 1 ORDER BY i) AS k
  FROM (SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 3, '0') AS name FROM range({n}) r(i))),
fill AS (
  SELECT CAST(-1 AS BIGINT) AS step, CAST(-1 AS BIGINT) AS slot, CAST(repeat('0', {m}) AS BIT) AS used
  UNION ALL
  SELECT step, slot, set_bit(used, CAST(slot AS INT), 1) FROM (
    SELECT f.step + 1 AS step, f.used, (s.o[(f.step + 1) % {n} + 1] + s.k[(f.step + 1) % {n} + 1] *
      list_filter(range({m}), lambda j: get_bit(f.used,
        CAST((s.o[(f.step + 1) % {n} + 1] + s.k[(f.step + 1) % {n} + 1] * j) % {m} AS INT)) = 0)[1]) % {m} AS slot
    FROM fill f, shards s WHERE f.step + 1 < {m})),
placed AS (SELECT slot, CAST(step % {n} AS INT) AS shard FROM fill WHERE step >= 0)
SELECT d.{row}, p.slot, p.shard FROM {source} d
JOIN placed p ON p.slot = {h("coalesce(CAST(d.doc_id AS VARCHAR), '')")} % {m}"""


def chat_sql() -> str:
    planted = r"'\### Assistant: </turn> ok'"
    esc = lambda x: rf"replace(replace(replace({x}, '\', '\b'), '<', '\l'), '>', '\g')"
    return rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {planted} UNION ALL SELECT -7, 1, 'assistant', {planted}),
m AS (SELECT *, coalesce(lag(role) OVER w = role, false) AS merged FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
c AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
  sum(CASE WHEN merged THEN 6 ELSE 15 + length({esc('role')}) END + length({esc('text')})) AS formatted_chars
  FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM c"""


def quality_rows_sql(source: str = "documents") -> str:
    """Rows of ``source`` numbered, with measures and verdict: CTE body."""
    stops = ", ".join("'" + w + "'" for w in sorted({w for ws in quality.STOP_WORDS.values() for w in ws}))
    broken = lambda rules: " || ".join(
        "CASE WHEN " + " OR ".join(
            ([f"{r.numerator} < {r.least} * {r.denominator or 1}"] if r.least is not None else [])
            + ([f"{r.numerator} > {r.most} * {r.denominator or 1}"] if r.most is not None else []))
        + f" THEN ',{r.name}' ELSE '' END" for r in rules)
    symbols = "regexp_replace(t, '[^#*$%&|<>]', '', 'g')"
    letters = r"regexp_replace(t, '[^\p{L}]', '', 'g')"
    upper = r"regexp_replace(t, '[^\p{Lu}]', '', 'g')"
    return rf"""
docs AS (SELECT *, row_number() OVER () AS rn, coalesce(text, '') AS t, {WORDS} AS ws FROM {source}),
runs AS (SELECT rn, i, array_to_string(ws[i:i + 7], ' ') AS run
  FROM (SELECT rn, ws, unnest(range(1, len(ws) - 6)) AS i FROM docs WHERE len(ws) >= 8)),
again AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, run) AS n FROM runs) WHERE n > 1),
covered AS (SELECT rn, sum(least(8, coalesce(nxt - i, 8))) AS n FROM
  (SELECT rn, i, lead(i) OVER (PARTITION BY rn ORDER BY i) AS nxt FROM again) GROUP BY rn),
counted AS (SELECT docs.*, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length({symbols}) AS BIGINT) AS n_symbols,
  len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines,
  CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
    - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT)
    AS n_dup_lines,
  length({letters}) AS n_letters, length({upper}) AS n_upper,
  len(list_filter(ws, lambda x: lower(x) IN ({stops}))) AS n_stop_words,
  CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM docs LEFT JOIN covered ON docs.rn = covered.rn),
judged AS (SELECT *, {broken(quality.BASE_RULES)} AS base, {broken(quality.RULES)} AS more FROM counted)"""


def quality_sql() -> str:
    return f"""WITH {quality_rows_sql()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base <> '' AS base_failed,
  base || more = '' AS kept, substr(base || more, 2) AS broken_rules FROM judged"""


def trie_sql() -> str:
    # crc32 bit by bit: a byte is xored in, then eight shifts
    crc = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
      string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""
    return f"""
WITH t AS MATERIALIZED (SELECT conv_id, coalesce(text, '') AS text, {crc} % {prefix_trie.HEADS} AS h,
  conv_id - conv_id % {prefix_trie.GROUP} AS donor,
  sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id, donor, h FROM t),
turns AS (SELECT c.conv_id, t.i, t.id, t.text FROM convs c JOIN t ON t.conv_id = c.donor AND t.i <= c.h
  UNION ALL SELECT conv_id, i, id, text FROM t WHERE i > h),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS depth, len({WORDS}) AS words FROM turns),
prefixes AS (SELECT conv_id, depth, words,
  string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM numbered
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
deepest AS (SELECT conv_id, max(depth) AS d FROM prefixes GROUP BY conv_id),
nodes AS MATERIALIZED (SELECT path, any_value(p.depth) AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs,
  (count(*) - 1) * any_value(words) AS saved,
  coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (p.depth = e.d), '') AS ends
  FROM prefixes p JOIN deepest e ON p.conv_id = e.conv_id GROUP BY path),
up AS (SELECT c.path AS top, count(*) FILTER (n.depth = c.depth + 1) AS children, sum(n.saved) AS saved,
  count(*) FILTER (n.path NOT IN (SELECT path[:-65] FROM nodes WHERE depth > 0)) AS leaves
  FROM nodes n, LATERAL (SELECT unnest(range(n.depth + 1)) AS k) x JOIN nodes c ON c.path = n.path[:64 * x.k]
  GROUP BY c.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, up.children AS n_children,
  up.leaves AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN up ON up.top = n.path LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:-65]"""


def clustering_sql() -> str:
    square = "list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    n = pivots.DIMENSIONS
    parts = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rn, vec_id,
  list_transform(embedding, lambda x: CAST(floor({pivots.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {n}
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {n}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{pivots.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1
  AS k, v FROM kept ORDER BY k LIMIT {pivots.K})"""]
    for r in range(pivots.ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT rn, min(struct_pack(d := d, k := k)) AS b FROM (
  SELECT v.rn, c.k, CAST({square} AS BIGINT) AS d FROM kept v, c{r} c) GROUP BY rn)""")
        if r < pivots.ROUNDS:
            parts.append(f"""m{r} AS (SELECT k, list(m ORDER BY i) AS v FROM (
  SELECT k, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM (
    SELECT a.b.k AS k, unnest(v.v) AS x, unnest(range({n})) AS i FROM a{r} a JOIN kept v ON a.rn = v.rn)
  GROUP BY k, i) GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m ON c.k = m.k)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT v.vec_id, CAST(a.b.k AS INTEGER) AS cluster, a.b.d AS distance,
  CAST(sum(a.b.d) OVER (PARTITION BY a.b.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.b.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{pivots.ROUNDS} a JOIN kept v ON a.rn = v.rn JOIN c{pivots.ROUNDS} c ON c.k = a.b.k"""


ORACLE = {"op1_mixing": mixing_sql(), "op3_sharding": sharding_sql(), "op5_chat_formatting": chat_sql(),
          "op10_quality": quality_sql(), "op11_prefix_trie": trie_sql(), "op13_centroid_clustering": clustering_sql()}
