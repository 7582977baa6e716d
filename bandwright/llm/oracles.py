"""DuckDB SQL for the rows of the queries that SQL can express."""

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"
_NAME = "coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))"
_U = f"((('0x' || substr(md5('42:' || {_NAME}), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"

OP1 = rf"""
WITH RECURSIVE units AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size,
         CASE WHEN length(text) > 0 THEN greatest(0.1::DOUBLE, 1.0::DOUBLE - 4.0::DOUBLE
              * (length(text) - length(translate(text, '#*$%&|<>', '')))::DOUBLE / length(text)::DOUBLE)
              ELSE 1.0::DOUBLE END AS w,
         {_U} AS u
  FROM documents
), keyed AS (
  SELECT doc_id, source, size, -ln(u) / w AS key FROM units
), found AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source
), weighed AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][
           ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM found
), filled AS (
  -- In the order in which sources reach their cap, the level if exactly those before are capped.
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
  FROM weighed
), levelled AS (
  SELECT *, (SELECT level FROM filled WHERE cap > level * weight ORDER BY cap / weight, source LIMIT 1) AS height FROM filled
), targets AS (
  SELECT source, source_size, CASE WHEN cap <= height * weight THEN cap ELSE height * weight END AS target FROM levelled
), rooms AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM targets
), p0 AS (
  SELECT k.doc_id, k.source, k.size, k.key, r.target, r.target - r.epochs * r.source_size AS room
  FROM keyed k JOIN rooms r ON k.source IS NOT DISTINCT FROM r.source
), stopped AS (
  -- Documents that fit the whole room, but not what those before them left.
  SELECT * FROM (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS until
    FROM p0 WHERE size > 0 AND size <= room
  ) WHERE until > room
), heads AS (
  SELECT source, room, arg_min(doc_id, key) AS head, arg_min(size, key) AS head_size FROM stopped GROUP BY source, room
), starts AS (
  SELECT 1 AS try, p0.* FROM p0
  UNION ALL
  SELECT 2, p0.doc_id, p0.source, p0.size, p0.key, p0.target, heads.room - head_size
  FROM p0 JOIN heads ON p0.source IS NOT DISTINCT FROM heads.source WHERE p0.doc_id <> head
), passes AS (
  -- Each pass takes in key order what fits, and goes on with the rest in what room is left.
  SELECT 0 AS pass, try, doc_id, source, size, key, room, FALSE AS now FROM starts WHERE size > 0 AND size <= room
  UNION ALL
  SELECT pass + 1, try, doc_id, source, size, key,
         room - sum(CASE WHEN until <= room THEN size ELSE 0 END) OVER (PARTITION BY try, source), until <= room
  FROM (
    SELECT *, sum(size) OVER (PARTITION BY try, source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS until
    FROM passes WHERE NOT now AND size <= room
  )
), taken AS (
  SELECT try, doc_id, source, size FROM passes WHERE now
), used AS (
  SELECT try, source, sum(size) AS used FROM taken GROUP BY try, source
), lefts AS (
  SELECT s.*, s.room - coalesce(u.used, 0) AS remaining
  FROM starts s LEFT JOIN used u ON s.try = u.try AND s.source IS NOT DISTINCT FROM u.source
), lasts AS (
  SELECT l.*, abs(l.size - remaining) AS gap FROM lefts l ANTI JOIN taken t ON l.try = t.try AND l.doc_id = t.doc_id
  WHERE l.size > 0 AND abs(l.size - remaining) < remaining
  QUALIFY row_number() OVER (PARTITION BY l.try, l.source ORDER BY gap, l.key, l.doc_id) = 1
), missed AS (
  SELECT l.try, l.source, any_value(l.target) AS target, coalesce(min(x.gap), any_value(l.remaining)) AS missed
  FROM lefts l LEFT JOIN lasts x ON l.try = x.try AND l.source IS NOT DISTINCT FROM x.source GROUP BY l.try, l.source
), tries AS (
  SELECT m1.source, CASE WHEN m1.missed > 0.01::DOUBLE * m1.target AND m2.missed < m1.missed THEN 2 ELSE 1 END AS try
  FROM missed m1 LEFT JOIN missed m2 ON m2.try = 2 AND m1.source IS NOT DISTINCT FROM m2.source WHERE m1.try = 1
), chosen AS (
  SELECT try, doc_id, source FROM taken
  UNION ALL SELECT try, doc_id, source FROM lasts
  UNION ALL SELECT 2, head, source FROM heads
), final AS (
  SELECT c.doc_id FROM chosen c JOIN tries t ON c.try = t.try AND c.source IS NOT DISTINCT FROM t.source
)
SELECT k.doc_id, k.size, r.source_size, r.target,
       ((r.epochs + (k.doc_id IN (SELECT doc_id FROM final))::INT) * k.size)::BIGINT AS taken
FROM keyed k JOIN rooms r ON k.source IS NOT DISTINCT FROM r.source
"""

OP4 = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), grouped AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM grouped
"""

OP8 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '~') AS host, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS place FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, host, text, trim(regexp_replace(lower(line), '[\x20\x09\x0B-\x0D]+', ' ', 'g')) AS line,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, host, text, unnest(lines) AS line FROM split)
), sizes AS (
  SELECT host, count(DISTINCT text) AS texts FROM docs GROUP BY host
), often AS (
  SELECT host, line FROM lines JOIN sizes USING (host) GROUP BY host, line, texts
  HAVING count(DISTINCT text) > 10 AND count(DISTINCT text) > 0.02::DOUBLE * texts
), lost AS (
  SELECT doc_id, sum(n) AS n FROM lines JOIN often USING (host, line) GROUP BY doc_id
), counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(translate(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0) AS lost
  FROM split LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost <= 70 * n_words AS kept
FROM counted
"""


def _op11(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Vectors and centroids as one row per component; each round assigns every vector, then moves the centroids."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
d{i} AS MATERIALIZED (
  SELECT r, c, sum((v.x - m.x) * (v.x - m.x))::BIGINT AS d FROM components v JOIN c{i} m USING (p) GROUP BY r, c
), a{i} AS MATERIALIZED (
  SELECT r, c, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)""")
        if i < rounds:
            steps.append(f"""
s{i} AS (
  SELECT c, p, sum(x)::BIGINT AS total, count(*) AS n FROM a{i} JOIN components USING (r) GROUP BY c, p
), c{i + 1} AS MATERIALIZED (
  SELECT o.c, o.p, CASE WHEN n IS NULL THEN o.x ELSE (total - ((total % n) + n) % n) // n END AS x
  FROM c{i} o LEFT JOIN s{i} s ON o.c = s.c AND o.p = s.p
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), components AS MATERIALIZED (
  SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM kept
), first AS (
  SELECT r, row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, 'null')), v) - 1 AS c FROM kept
  QUALIFY c < {k}
), c0 AS MATERIALIZED (
  SELECT c, p, x FROM first JOIN components USING (r)
),{",".join(steps)}, named AS (
  SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY p)) AS centroid_sha256 FROM c{rounds} GROUP BY c
)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN named USING (c)
"""


OP12 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs)
), least AS (
  SELECT win, min(doc_id) AS first FROM windows GROUP BY win HAVING count(DISTINCT doc_id) > 1
), gone AS (
  SELECT DISTINCT doc_id, i FROM windows JOIN least USING (win) WHERE doc_id > first
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs
), placed AS (
  -- A word is covered if the last repeated window that starts at it or before it reaches it.
  SELECT x.doc_id, word, p, p - max(i) OVER (PARTITION BY x.doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) < 50 AS covered
  FROM words x LEFT JOIN gone ON x.doc_id = gone.doc_id AND p = i
), kept AS (
  SELECT doc_id, count(*) FILTER (WHERE covered) AS n, string_agg(word, ' ' ORDER BY p) FILTER (WHERE covered IS NOT TRUE) AS rest
  FROM placed GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

ORACLE: dict[str, str] = {
    "op1_mix_sources": OP1,
    "op4_warc": OP4,
    "op8_quality_rules": OP8,
    "op11_centroid_clusters": _op11(),
    "op12_substring_dedup": OP12,
}
