"""SQL (DuckDB) of the registered queries that SQL can express, over the same tables."""

from __future__ import annotations

from itertools import permutations

from affinia.llm import clustering, decontaminate, filter_audit, sharding, substrings, warc

_WORD = r"[^\x20\x09-\x0D]+"


def _crc32(text: str) -> str:
    """SQL of the CRC-32 of a text's bytes: two steps of four bits for each byte."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)

    def step(c: str) -> str:
        return f"xor({c} >> 4, ({table}::BIGINT[])[({c} & 15) + 1])"

    digit = "instr('0123456789ABCDEF', p[{}]) - 1"
    return f"""xor(list_reduce(
  list_transform(regexp_extract_all(hex(encode({text})), '..'),
                 lambda p: ({digit.format(2)} + 16 * ({digit.format(1)}))::BIGINT),
  lambda c, d: {step("(" + step("xor(c, d)") + ")")}, 4294967295::BIGINT), 4294967295)"""


def _feistel(source: str) -> str:
    """SQL rows of ``source`` with column x replaced by one pass of the network."""
    first, second = sharding.MULTIPLIERS
    low = (1 << 32) - 1
    sql = f"SELECT * EXCLUDE (x), x >> r AS a, x & ((1::UBIGINT << r) - 1) AS b FROM {source}"
    for i, key in enumerate(sharding.round_keys(sharding.SEED)):
        width = "lr"[i % 2]
        sql = f"SELECT *, (b * {first} + {key}) & {low} AS z FROM ({sql})"
        sql = f"SELECT * EXCLUDE (z), (xor(z, z >> 15) * {second}) & {low} AS z FROM ({sql})"
        sql = (
            "SELECT * EXCLUDE (a, b, z), b AS a, "
            f"xor(a, xor(z, z >> 13) & ((1::UBIGINT << {width}) - 1)) AS b FROM ({sql})"
        )
    return f"SELECT * EXCLUDE (a, b), a << r | b AS x FROM ({sql})"


SHARDING = f"""
WITH RECURSIVE sized AS MATERIALIZED (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
         {_crc32("coalesce(text, '')")} AS text_crc32 FROM documents),
rows AS MATERIALIZED (
  SELECT *, (row_number() OVER (ORDER BY doc_id, size, text_crc32) - 1)::UBIGINT AS number FROM sized),
halves AS (
  SELECT n, bits // 2 AS l, bits - bits // 2 AS r FROM (
    SELECT count(*)::UBIGINT AS n, greatest(2, ceil(log2(count(*))))::UBIGINT AS bits FROM documents)),
started AS (SELECT number, number AS x, n, l, r FROM rows, halves),
walk AS (
  SELECT number, n, l, r, x FROM ({_feistel("started")})
  UNION ALL
  SELECT number, n, l, r, x FROM ({_feistel("(SELECT * FROM walk WHERE x >= n)")}))
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % {sharding.SHARDS})::INTEGER AS shard,
       (x // {sharding.SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM rows JOIN walk USING (number) WHERE x < n
"""


def _clustering() -> str:
    d, k = clustering.DIMENSION, clustering.CLUSTERS
    distance = "sum((v.x - c.x) * (v.x - c.x))"

    def nearest(i: int) -> str:
        return f"""
near{i} AS MATERIALIZED (
  SELECT vec_id, arg_min(cluster, (d, cluster)) AS cluster, min(d)::BIGINT AS d FROM (
    SELECT v.vec_id, c.cluster, {distance} AS d FROM component v JOIN c{i} c USING (i) GROUP BY 1, 2)
  GROUP BY 1)"""

    parts = [f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, [floor({clustering.SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {d} AND len([x FOR x IN embedding IF isfinite(x)]) = {d}),
component AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, unnest(range({d})) AS i FROM kept),
c0 AS MATERIALIZED (
  SELECT cluster, unnest(v) AS x, unnest(range({d})) AS i FROM (
    SELECT v, row_number() OVER (ORDER BY sha256('{clustering.SEED}:' || vec_id), v) - 1 AS cluster FROM kept)
  WHERE cluster < {k})"""]
    for i in range(clustering.ROUNDS):
        parts += [nearest(i), f"""
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, c.i, coalesce((s - ((s % n) + n) % n) // n, c.x) AS x
  FROM c{i} c LEFT JOIN (
    SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM component JOIN near{i} USING (vec_id) GROUP BY 1, 2)
  USING (cluster, i))"""]
    last = clustering.ROUNDS
    parts.append(nearest(last))
    return ",".join(parts) + f""",
hashes AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY 1)
SELECT vec_id, cluster::INTEGER AS cluster, d AS distance,
       sum(d) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, centroid_sha256
FROM near{last} JOIN hashes USING (cluster)"""


CLUSTERING = _clustering()

_ORDERS = ", ".join("'" + "".join(p) + "'" for p in permutations(filter_audit.FILTERS))

FILTER_AUDIT = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
flagged AS MATERIALIZED (
  SELECT doc_id, part,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * len(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM texts),
marked AS MATERIALIZED (
  SELECT part, fails, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
  FROM flagged LEFT JOIN labels USING (doc_id) GROUP BY 1, 2),
orders AS (SELECT unnest([{_ORDERS}]) AS filter_order),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
counted AS MATERIALIZED (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
         n, good, toxic, fails, contains(fails, letter) AS own,
         len(regexp_replace(fails, '[^' || substr(filter_order, 1, step) || ']', '', 'g')) > own::INT AS earlier
  FROM marked, steps),
summed AS MATERIALIZED (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT own AND NOT earlier THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN own AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN own AND earlier THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = letter THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN own AND NOT earlier THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN own AND NOT earlier THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM counted GROUP BY ALL)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM summed
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _plain_words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_PLAIN}')"


DECONTAMINATION = f"""
WITH item_words AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, {_plain_words("text")} AS w FROM benchmark),
item_windows AS MATERIALIZED (
  SELECT DISTINCT item, least(len(w), {decontaminate.WINDOW}) AS n,
         array_to_string(w[i:i + {decontaminate.WINDOW} - 1], ' ') AS part
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - {decontaminate.WINDOW} + 1) + 1)) AS i
        FROM item_words WHERE len(w) > 0)),
doc_words AS MATERIALIZED (SELECT doc_id, {_plain_words("text")} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS part
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes)),
hits AS MATERIALIZED (
  SELECT doc_id, i, n, item FROM doc_windows JOIN item_windows USING (n, part)),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

WARC = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS size FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS lowest FROM payloads)
SELECT page_id, size AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN size >= {warc.LEAST} AND page_id > lowest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= {warc.LEAST} AND page_id > lowest THEN lowest END AS refers_to
FROM firsts
"""

SUBSTRINGS = rf"""
WITH docs AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(w[i:i + {substrings.WINDOW} - 1], ' ') AS part
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {substrings.WINDOW} + 2)) AS i FROM docs)),
earliest AS (SELECT part, min(doc_id) AS lowest FROM windows GROUP BY 1),
gone AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(range(i, i + {substrings.WINDOW})) AS pos
  FROM windows JOIN earliest USING (part) WHERE lowest < doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM docs)
  ANTI JOIN gone USING (doc_id, pos) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""
