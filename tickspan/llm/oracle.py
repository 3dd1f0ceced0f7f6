"""Oracle SQL (DuckDB) of the operators that SQL can express."""

from __future__ import annotations

from tickspan.llm import decontam, license_scan, quality, sharding, url_filter
from tickspan.llm.licence_texts import FULL, KNOWN

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS t
           FROM documents),
w AS (SELECT r, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
win AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s
        FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM w)),
twice AS (SELECT r, s FROM win GROUP BY r, s HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM win JOIN twice USING (r, s))
        GROUP BY r),
lines AS (SELECT r, sum(c - 1) AS n FROM (
            SELECT r, l, count(*) AS c FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
            WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r, l) GROUP BY r),
m AS (SELECT d.doc_id, d.host, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)),
b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
      FROM m),
h AS (SELECT host, count(*) AS n, count(*) FILTER (base_failed) AS f FROM b GROUP BY host),
p AS (SELECT count(*) AS k, sum(n) AS n, sum(f) / sum(n) AS mean, sum(n * n) AS n2, sum(f * f / n) AS s FROM h),
q AS (SELECT mean, CASE WHEN mean * (1 - mean) > 0 AND k > 1 THEN
             least(greatest((s - n * mean * mean - (k - 1) * mean * (1 - mean))
                            / (mean * (1 - mean) * greatest(n - n2 / n - (k - 1), 1)), 1 / (1 + {quality.STRONGEST})), 0.999)
             END AS spread FROM p),
z AS (SELECT host, (f + mean * coalesce((1 - spread) / spread, {quality.STRONGEST}))
                   / (n + coalesce((1 - spread) / spread, {quality.STRONGEST})) > {quality.MAX_RATE} AS host_failed FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_failed AS kept, host_failed
FROM b JOIN z USING (host)
"""


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


# All equal pairs of positions, not seeds: counts by offset, then the best window.
DECONTAMINATION = f"""
WITH every AS (SELECT * FROM (SELECT item_id, {_words('text')} AS ws FROM benchmark) WHERE len(ws) >= 1),
b AS (SELECT * FROM every WHERE len(ws) >= {decontam.LEAST_WORDS}),
bp AS (SELECT item_id, len(ws) AS size, least(len(ws), {decontam.WINDOW}) AS span, unnest(ws) AS w,
              unnest(range(1, len(ws) + 1)) AS j FROM b),
d AS (SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS ws FROM documents),
dp AS (SELECT r, doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d),
eq AS (SELECT r, doc_id, item_id, size, span, i - j AS o, j FROM dp JOIN bp USING (w)),
many AS (SELECT r, item_id, o FROM eq GROUP BY r, item_id, o, span HAVING count(*) >= {decontam.SHARE} * span),
win AS (SELECT r, doc_id, item_id, o, span, unnest(range(greatest(1, j - span + 1), least(j, size - span + 1) + 1)) AS s
        FROM eq JOIN many USING (r, item_id, o)),
n AS (SELECT doc_id, item_id, span, count(*) AS c FROM win GROUP BY r, doc_id, item_id, o, span, s)
SELECT doc_id, item_id, CAST(max(c) AS BIGINT) AS n_equal, CAST(max(span) AS BIGINT) AS n_window
FROM n WHERE c >= {decontam.SHARE} * span GROUP BY doc_id, item_id
UNION ALL
SELECT DISTINCT doc_id, item_id, CAST(len(ws) AS BIGINT), CAST(len(ws) AS BIGINT) FROM d JOIN every USING (ws)
WHERE len(ws) < {decontam.LEAST_WORDS}
"""


def _canonical(text: str) -> str:
    form = f"regexp_replace(lower({text}), '(?m){license_scan.COPYRIGHT}', '', 'g')"
    form = f"regexp_replace({form}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    for a, b in license_scan.SPELLINGS:
        form = f"replace({form}, '{a}', '{b}')"
    return form


def _one_line(form: str) -> str:
    return f"trim(regexp_replace({form}, '[ \\n]+', ' ', 'g'))"


_KNOWN = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in (*KNOWN, *FULL))
LICENSES = f"""
WITH k AS (SELECT sha256(f) AS digest, min(license) AS license FROM (
             SELECT license, {_one_line(_canonical('text'))} AS f FROM (VALUES {_KNOWN}) AS v(license, text)) GROUP BY f),
d AS (SELECT doc_id, {_canonical("coalesce(text, '')")} AS f FROM documents),
u AS (SELECT doc_id, 0 AS line, {_one_line('f')} AS f FROM d UNION ALL
      SELECT doc_id, line, trim(f) FROM (
        SELECT doc_id, unnest(string_split(f, chr(10))) AS f, unnest(range(1, len(string_split(f, chr(10))) + 1)) AS line FROM d))
SELECT doc_id, CASE WHEN line = 0 THEN 'text' ELSE 'line' END AS scope, CAST(line AS BIGINT) AS line, license, digest
FROM u JOIN k ON sha256(u.f) = k.digest
"""


#: More rounds than scores of whole numbers can go on changing.
ORACLE_ROUNDS = 400


def _url_filter() -> str:
    f = url_filter
    rules = ", ".join(f"('{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{r}', '{a}')" for r, a in f.RULES)
    host = f"translate(regexp_extract({{}}, '^[^/?#]*'), '{f.UPPER}', '{f.LOWER}')"
    rest = "CASE WHEN strpos(coalesce({0}, ''), '://') > 0 THEN substr({0}, strpos({0}, '://') + 3) ELSE '' END"
    return f"""
WITH RECURSIVE u AS (SELECT row_number() OVER () AS r, page_id, html, {rest.format('url')} AS rest FROM pages),
p AS (SELECT r, page_id, html, {host.format('rest')} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules AS (SELECT * FROM (VALUES {rules}) AS v(parent, prefix, rule, action)),
fit AS (SELECT r, max_by(rule, (length(rule), rule)) AS rule, max_by(action, (length(rule), rule)) AS action
        FROM p JOIN rules ON (host = parent OR ends_with(host, '.' || parent)) AND starts_with(path, prefix) GROUP BY r),
j AS (SELECT r, page_id, host, path, rule, action FROM p LEFT JOIN fit USING (r)),
seed AS (SELECT host AS h, 2 * count(*) FILTER (action = 'allow') > count(*) AS good,
                2 * count(*) FILTER (action = 'block') > count(*) AS bad FROM j WHERE host <> '' GROUP BY host),
l AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''),
             '(?i)<a\\s[^>]*?href\\s*=\\s*["'']?((?:https?:)?//[^"''\\s>]+)', 1)) AS href FROM p),
e AS (SELECT src, dst, count(*) AS n FROM (
        SELECT src, {host.format("regexp_replace(href, '^(?i)(https?:)?//', '')")} AS dst FROM l)
      WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
both_ways AS (SELECT true AS t, src AS h, dst AS o, n FROM e UNION ALL SELECT false, dst, src, n FROM e),
part AS (SELECT t, h, o, CAST({f.DAMPING} AS DOUBLE) * n / sum(n) OVER (PARTITION BY t, h) AS part FROM both_ways),
s0 AS (SELECT good AS t, h, CAST({int(f.UNIT * (1 - f.DAMPING))} AS BIGINT) AS s FROM seed WHERE good OR bad),
walk AS (SELECT 0 AS i, t, h, s FROM s0 UNION ALL
         SELECT i, t, h, CAST(sum(s) AS BIGINT) FROM (
           SELECT w.i + 1 AS i, t, o AS h, CAST(floor(w.s * part) AS BIGINT) AS s FROM walk w JOIN part USING (t, h) WHERE w.i < {ORACLE_ROUNDS}
           UNION ALL SELECT n.i + 1, s0.t, s0.h, s0.s FROM s0, (SELECT max(i) AS i FROM walk) n WHERE n.i < {ORACLE_ROUNDS}) GROUP BY i, t, h),
z AS (SELECT h AS host, sum(s) FILTER (t) AS trust, sum(s) FILTER (NOT t) AS distrust FROM walk
      WHERE i = (SELECT max(i) FROM walk) AND s > 0 GROUP BY h)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN coalesce(distrust, 0) > {f.MARGIN} * coalesce(trust, 0)
       THEN 'block' ELSE 'allow' END) AS verdict, CAST(coalesce(trust, 0) AS BIGINT) AS trust,
       CAST(coalesce(distrust, 0) AS BIGINT) AS distrust
FROM j LEFT JOIN z USING (host)
"""


URL_FILTER = _url_filter()


def _draw(salt: str) -> str:
    digits = sharding.BITS // 4
    return f"CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '{salt}'), 1, {digits}) AS BIGINT)"


def _winner(n: int) -> str:
    cost = ", ".join(f"{{'cost': -ln(({_draw(f':{s}')} + 0.5) / {float(1 << sharding.BITS)}), 'shard': {s}}}" for s in range(n))
    return f"CAST(list_min([{cost}]).shard AS INTEGER)"


# DuckDB has no CRC-32: the remainder of the division, byte by byte from a table made here.
SHARDING = f"""
WITH t AS (SELECT list(c ORDER BY b) AS tab FROM (
    SELECT b, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b))),
d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x,
             {_winner(8)} AS shard, {_winner(9)} AS grown_shard, {_draw('')} AS mark FROM documents),
b AS (SELECT r, i, CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT) AS v
      FROM (SELECT r, x, unnest(range(length(x) // 2)) AS i FROM d))
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY mark, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM (SELECT d.*, CAST(length(x) // 2 + 1 AS BIGINT) AS size, CAST(coalesce(crc, 0) AS BIGINT) AS text_crc32
      FROM d LEFT JOIN (SELECT r, xor(list_reduce(list(v ORDER BY i), lambda c, v: xor(c >> 8, tab[(xor(c, v) & 255) + 1]), 4294967295),
                                      4294967295) AS crc
                        FROM b, t GROUP BY r, tab) USING (r))
"""


def _centroids(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2") -> str:
    """All distances in every round; a round's centroids are its predecessor's clusters' floored means."""
    def nearest(now: int) -> str:
        d = "list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        return (f"a{now} AS MATERIALIZED (SELECT r, vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS m FROM "
                f"(SELECT kept.r, kept.vec_id, kept.v, c.c, CAST({d} AS BIGINT) AS d FROM kept, c{now} AS c) GROUP BY r, vec_id)")

    def means(now: int) -> str:
        return (f"m{now} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, "
                f"count(*) AS n FROM (SELECT m.c AS c, unnest(v) AS x, unnest(range({dims})) AS i FROM a{now}) GROUP BY c, i) GROUP BY c),\n"
                f"c{now + 1} AS MATERIALIZED (SELECT c, coalesce(m.v, o.v) AS v FROM c{now} AS o LEFT JOIN m{now} AS m USING (c))")
    steps = ",\n".join(x for now in range(rounds) for x in (nearest(now), means(now)))
    return f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE len(embedding) = {dims}),
kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(e, lambda x: CAST(floor({scale} * x) AS BIGINT)) AS v FROM e
         WHERE len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
        SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT {k})),
{steps},
{nearest(rounds)}
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} AS c ON c.c = m.c
"""


CENTROIDS = _centroids()
