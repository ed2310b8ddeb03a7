"""The registered queries as DuckDB SQL."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH words AS (SELECT doc_id, {WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM places),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, i + d AS i FROM later, (SELECT unnest(range(0, 20)) AS d)),
single AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM single ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

OP3 = f"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
    (CAST('0x' || substr(md5('mix:' || doc_id), 1, 13) AS BIGINT) + 0.5) / CAST(4503599627370496 AS DOUBLE) AS u FROM documents),
sized AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
weighted AS (SELECT *, CAST(source_size * 3 AS DOUBLE) AS cap,
    CAST([5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS DOUBLE) AS weight FROM sized),
levels AS (SELECT *, row_number() OVER o AS place, (CAST(sum(source_size) OVER () AS DOUBLE)
      - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
shared AS (SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= cap),
goals AS (SELECT l.source, source_size, least(cap, s.level * weight) AS target FROM levels l, shared s),
dues AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS due FROM goals),
parts AS (SELECT *, floor(due) AS copies, due - floor(due) AS share, target - floor(due) * source_size AS rest FROM dues),
ranked AS (SELECT d.doc_id, size, p.*, u * (1 - share) / (u * (1 - share) + share * (1 - u)) AS r
    FROM d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source),
summed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY r, CAST(doc_id AS VARCHAR)) AS through FROM ranked),
gaps AS (SELECT *, rest - coalesce(max(through) FILTER (through <= rest) OVER (PARTITION BY source), 0) AS gap FROM summed),
fills AS (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY abs(size - gap), r, CAST(doc_id AS VARCHAR)) AS k
    FROM gaps WHERE through > rest AND abs(size - gap) < gap)
SELECT g.doc_id, size, source_size, target,
    CAST(size * (copies + CASE WHEN (through <= rest AND share > 0) OR k = 1 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM gaps g LEFT JOIN (SELECT * FROM fills WHERE k = 1) f USING (doc_id)
"""

OP4 = """
SELECT conv_id, turn, role, turn AS place_turn, CAST(NULL AS BIGINT) AS call_turn, CAST(NULL AS VARCHAR) AS problem,
       CAST(to_json({'content': text, 'role': role}) AS VARCHAR) AS message
FROM conversations
"""

OP6 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs)
SELECT * FROM ranked WHERE rank <= 5
"""

OP11 = f"""
WITH keyed AS (SELECT doc_id, {WORDS} AS w, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))) AS crc FROM documents),
hashed AS (SELECT doc_id, w, len(w) AS n, xor(crc, 4294967295) AS h, xor(crc, 4294967295) // 10 AS g FROM keyed),
placed AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM hashed),
periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
docs AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: CASE WHEN i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END) ELSE w END AS w FROM periods),
places AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM docs),
equal AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM places x JOIN places y
    ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 4 <= x.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
best AS (SELECT r.* FROM runs r WHERE NOT EXISTS (SELECT 1 FROM runs s WHERE s.doc_id = r.doc_id AND (s.length * r.period > r.length * s.period
    OR (s.length * r.period = r.length * s.period AND (s.start, s.period) < (r.start, r.period))))),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
       CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM docs d LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _clusters(k: int, rounds: int) -> str:
    steps = [f"""v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
k0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, e FROM v QUALIFY c < {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (SELECT rid, v.vec_id, v.e, k.c, CAST(list_inner_product(v.e, v.e) + list_inner_product(k.e, k.e)
    - 2 * list_inner_product(v.e, k.e) AS BIGINT) AS d FROM v, k{r} k),
a{r} AS MATERIALIZED (SELECT * FROM d{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT c, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
    FROM (SELECT c, unnest(e) AS x, unnest(range(64)) AS j FROM a{r}) GROUP BY c, j),
n{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY j) AS e FROM m{r} GROUP BY c),
k{r + 1} AS MATERIALIZED (SELECT c, coalesce(n{r}.e, k{r}.e) AS e FROM k{r} LEFT JOIN n{r} USING (c))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(k.e, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a{rounds} a JOIN k{rounds} k ON a.c = k.c
"""


SQL = {
    "op11_periodic_runs": OP11,
    "op12_centroid_clustering": _clusters(40, 5),
    "op4_chat_formatting": OP4,
    "op6_topk_search": OP6,
    "op3_mixing": OP3,
    "op1_substring_dedup": OP1,
}
