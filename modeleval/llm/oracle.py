"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from collections.abc import Sequence


def _shard_sql(shards: Sequence[str], slots: int) -> str:
    names = ", ".join(f"({i}, '{n}')" for i, n in enumerate(shards))
    n = len(shards)
    return f"""
WITH RECURSIVE names(i, name) AS (VALUES {names}),
orders AS (SELECT list(('0x' || substr(md5(name), 1, 8))::BIGINT % {slots} ORDER BY i) AS start,
                  list(('0x' || substr(md5(name), 9, 8))::BIGINT % {slots - 1} + 1 ORDER BY i) AS step FROM names),
-- one turn at a time: shard (turn % {n}) claims the first free slot of its order, from where it stopped
fill(turn, owner, tries) AS (
  SELECT 0, list_transform(range({slots}), lambda x: -1), list_transform(range({n}), lambda x: 0) UNION ALL
  SELECT turn + 1,
         list_transform(owner, lambda o, j: CASE WHEN j = claimed + 1 THEN turn % {n} ELSE o END),
         list_transform(tries, lambda a, j: CASE WHEN j = turn % {n} + 1 THEN tried + 1 ELSE a END)
  FROM (SELECT *, (start[turn % {n} + 1] + tried * step[turn % {n} + 1]) % {slots} AS claimed
        FROM (SELECT turn, owner, tries, start, step,
                     list_filter(range(tries[turn % {n} + 1], {slots}),
                                 lambda t: owner[(start[turn % {n} + 1] + t * step[turn % {n} + 1]) % {slots} + 1] < 0)[1] AS tried
              FROM fill, orders WHERE turn < {slots}))),
filled AS (SELECT owner FROM fill WHERE turn = {slots}),
lookup AS (SELECT unnest(range({slots})) AS slot, unnest(owner) AS i FROM filled),
placed AS (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {slots})::INT AS slot FROM documents)
SELECT doc_id, placed.slot AS slot, name AS shard FROM placed JOIN lookup USING (slot) JOIN names USING (i)"""


MIX_SQL = r"""
WITH k AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat_ws(chr(31), 'mix', coalesce('v' || doc_id::VARCHAR, 'n'), coalesce('v' || source, 'n'), md5(coalesce(text, '')))) AS draw
  FROM documents),
d AS (SELECT doc_id, source, size, greatest(size - size % (2 ** greatest(length(bin(size)) - 4, 0))::BIGINT, 1)::BIGINT AS cls,
             ('0x' || substr(md5(draw || ':' || (row_number() OVER (PARTITION BY draw) - 1)::VARCHAR), 1, 13))::BIGINT AS bits FROM k),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1)::INT % 3 + 1]::DOUBLE AS w,
             1.5::DOUBLE * sum(source_size) OVER () AS total FROM s),
r AS (SELECT *, 2.0::DOUBLE * source_size / w AS ratio FROM w),
l AS (SELECT a.*, (SELECT a.total - coalesce(sum(2.0::DOUBLE * b.source_size), 0) FROM r b WHERE (b.ratio, b.source IS NULL, coalesce(b.source, '')) < (a.ratio, a.source IS NULL, coalesce(a.source, '')))
             / (SELECT sum(b.w) FROM r b WHERE (b.ratio, b.source IS NULL, coalesce(b.source, '')) >= (a.ratio, a.source IS NULL, coalesce(a.source, ''))) AS lvl FROM r a),
g AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, (SELECT arg_min(lvl, ratio) FROM l WHERE lvl <= ratio) * w) AS target FROM l),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS certain FROM g),
z AS (SELECT *, target - certain * source_size AS quota FROM q),
-- c: classes above one are certain, the rest are drawn with p = c * class
v AS (SELECT source, cls, sum(size) AS words FROM d GROUP BY ALL),
x AS (SELECT v.source, cls, words, quota, (quota - (sum(words) OVER (PARTITION BY v.source ORDER BY cls DESC) - words))
             / nullif((sum(cls * words) OVER (PARTITION BY v.source ORDER BY cls))::DOUBLE, 0) AS c
      FROM v JOIN z ON v.source IS NOT DISTINCT FROM z.source WHERE quota > 0),
lv AS (SELECT source, arg_max(c, cls) FILTER (WHERE c * cls <= 1) AS c FROM x GROUP BY source),
p AS (SELECT d.*, source_size, target, certain, quota, least(1.0::DOUBLE, coalesce(c, 0) * cls) AS p, (bits + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN z ON d.source IS NOT DISTINCT FROM z.source LEFT JOIN lv ON d.source IS NOT DISTINCT FROM lv.source),
-- Pareto quotient q = u / (1 - u) * (1 - p) / p, ranked as q / (1 + q)
k2 AS (SELECT *, least(floor(u * (1 - p) / (u * (1 - p) + p * (1 - u)) * 4503599627370496.0::DOUBLE), 4503599627370495)::BIGINT AS rank FROM p),
sure AS (SELECT source, sum(size) AS sure FROM k2 WHERE p >= 1 GROUP BY source),
t AS (SELECT k2.source, rank, sum(sum(size)) OVER (PARTITION BY k2.source ORDER BY rank) - sum(size) / 2.0 AS middle,
             any_value(quota) - coalesce(any_value(sure), 0) AS quota
      FROM k2 LEFT JOIN sure ON k2.source IS NOT DISTINCT FROM sure.source WHERE p < 1 AND p > 0 GROUP BY k2.source, rank),
cut AS (SELECT source, max(rank) AS cut FROM t WHERE middle <= quota GROUP BY source)
SELECT doc_id, size, source_size, target, (size * (certain + (p >= 1 OR coalesce(rank <= cut, false))::INT))::BIGINT AS taken,
       (certain + (p >= 1 OR coalesce(rank <= cut, false))::INT)::BIGINT AS copies
FROM k2 LEFT JOIN cut ON k2.source IS NOT DISTINCT FROM cut.source"""


def _url_sql(rules: Sequence[tuple[str, str]]) -> str:
    values = ", ".join(f"('{v}', '{r}')" for v, r in rules)
    return f"""
WITH rules(verdict, rule) AS (VALUES {values}),
shaped AS (SELECT *, split_part(rule, '/', 1) AS rhost, substr(rule, length(split_part(rule, '/', 1)) + 1) AS rpath FROM rules),
p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw FROM p),
u AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path FROM h),
f AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
      FROM (SELECT DISTINCT host, path FROM u) JOIN shaped ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
      GROUP BY host, path)
SELECT page_id, u.host AS host, u.path AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN f ON u.host = f.host AND u.path = f.path"""


EXACT_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256 FROM d"""


def _centroid_sql(k: int, rounds: int, dims: int) -> str:
    def assigned(centroids: str) -> str:
        return f"""(SELECT rid, arg_min(c, (apart, c)) AS c, min(apart) AS distance FROM (
  SELECT v.rid, m.c, list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS apart
  FROM v, {centroids} m) GROUP BY rid)"""

    steps = []
    for r in range(1, rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED {assigned(f"c{r - 1}")},
s{r} AS (SELECT c, i, sum(xi)::BIGINT AS s, count(*) AS n FROM (
  SELECT c, unnest(x) AS xi, unnest(range({dims})) AS i FROM v JOIN a{r} USING (rid)) GROUP BY c, i),
c{r} AS MATERIALIZED (SELECT m.c, coalesce(n.x, m.x) AS x FROM c{r - 1} m LEFT JOIN (
  SELECT c, list((s - (s % n + n) % n) // n ORDER BY i) AS x FROM s{r} GROUP BY c) n USING (c))""")
    return f"""
WITH kept AS (SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, x FROM kept),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS c, x FROM v ORDER BY c LIMIT {k}),
{",".join(steps)},
z AS MATERIALIZED {assigned(f"c{rounds}")}
SELECT vec_id, z.c::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY z.c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM z JOIN v USING (rid) JOIN c{rounds} m ON m.c = z.c"""


def sql(shards: Sequence[str], slots: int, rules: Sequence[tuple[str, str]], centroids: int, rounds: int, dims: int) -> dict[str, str]:
    return {"op4_shard": _shard_sql(shards, slots), "op5_mix": MIX_SQL, "op7_urls": _url_sql(rules),
            "op11_centroids": _centroid_sql(centroids, rounds, dims), "op12_exact": EXACT_SQL}
