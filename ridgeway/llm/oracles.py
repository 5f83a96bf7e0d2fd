"""DuckDB SQL of the queries that SQL can say, over the raw tables."""

CHAT_FORMAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
named AS (
  SELECT conv_id, turn, text, CASE role WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant'
         WHEN 'bot' THEN 'assistant' WHEN 'model' THEN 'assistant' ELSE role END AS role FROM rows),
sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
         + len(regexp_extract_all(text, '</?s>|<</?SYS>>|\[/?(INST|TURN|ROLE)\]')) AS chars,
         length(role) + length(role) - length(replace(role, '\', ''))
         + len(regexp_extract_all(role, '</?s>|<</?SYS>>|\[/?(INST|TURN|ROLE)\]')) AS role_chars FROM named)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17
      ELSE role_chars + 31 END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
windows AS (
  SELECT rid, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)),
hits AS (SELECT rid, i, windows.n AS n, item FROM windows JOIN grams ON windows.n = grams.n AND windows.g = grams.g),
marked AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM d LEFT JOIN marked USING (rid) LEFT JOIN items USING (rid)
"""

WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, octet_length(encode(payload)) AS bytes, sha1(payload) AS hex FROM p),
coded AS (
  SELECT page_id, bytes, hex,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)
      FOR i IN range(32)], '') AS digest FROM h),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM coded)
SELECT page_id, bytes::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""

NEAR_DEDUP = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(list_slice(w, i, i + 3), ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM d),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
    AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, len(s)::BIGINT AS n_shingles, low AS component_id, doc_id = low AS kept
FROM sets JOIN (SELECT x, min(y) AS low FROM reach GROUP BY x) ON x = doc_id
"""

SOURCE_MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
weighed AS (SELECT *, 2 * n AS cap, [3, 1, 2][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT]::BIGINT AS w FROM sources),
ranked AS (
  SELECT *, row_number() OVER poorest AS k,
    150 * (sum(n) OVER ())::HUGEINT - 100 * coalesce(sum(cap) OVER (poorest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS a,
    100 * (sum(w) OVER (poorest ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS b
  FROM weighed WINDOW poorest AS (ORDER BY cap::DOUBLE / w, source)),
level AS (SELECT k, a, b FROM ranked WHERE w * a <= cap * b ORDER BY k LIMIT 1),
aims AS (
  SELECT source, n, CASE WHEN ranked.k < coalesce(level.k, 1e9) THEN cap::DOUBLE ELSE (w * level.a)::DOUBLE / level.b::DOUBLE END AS target,
    CASE WHEN ranked.k < coalesce(level.k, 1e9) THEN cap ELSE (w * level.a) // level.b END::BIGINT AS aim FROM ranked LEFT JOIN level ON true),
goals AS (SELECT source, n, target, CASE WHEN n > 0 THEN aim // n ELSE 0 END AS whole, CASE WHEN n > 0 THEN aim % n ELSE 0 END AS rest FROM aims),
ties AS (SELECT source, h, size, count(*) AS c FROM d GROUP BY source, h, size),
placed AS (SELECT *, coalesce(sum(size * c) OVER (PARTITION BY source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM ties)
SELECT d.doc_id, d.size, g.n AS source_size, g.target,
  (g.whole * d.size + greatest(0, least(d.size, (g.rest - p.before) // p.c)))::BIGINT AS taken
FROM d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
JOIN placed p ON d.source IS NOT DISTINCT FROM p.source AND d.h = p.h AND d.size = p.size
"""


def ns_kmeans(k: int = 16, rounds: int = 3, d: int = 64, factor: int = 64) -> str:
    """All distances of every round, without bounds."""
    near = lambda c: f"""(SELECT rid, vec_id, x, c, dist FROM (
      SELECT rid, vec_id, v.x, c.c, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS dist
      FROM v, {c} c) q QUALIFY row_number() OVER (PARTITION BY rid ORDER BY dist, c) = 1)"""  # noqa: E731
    parts = [f"""v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor(e::DOUBLE * {factor})::BIGINT) AS x
      FROM embeddings WHERE len(embedding) = {d} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {d})""",
             f"""c0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM
      (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, 'null')) AS h, x FROM v ORDER BY h, x LIMIT {k}) s)"""]
    for t in range(rounds):
        parts += [f"a{t} AS MATERIALIZED {near(f'c{t}')}",
                  f"""m{t} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM (
      SELECT c, i, sum(e) AS s, count(*) AS n FROM (SELECT c, unnest(x) AS e, unnest(range({d})) AS i FROM a{t}) u GROUP BY c, i) g GROUP BY c)""",
                  f"c{t + 1} AS MATERIALIZED (SELECT c{t}.c, coalesce(m{t}.x, c{t}.x) AS x FROM c{t} LEFT JOIN m{t} ON c{t}.c = m{t}.c)"]
    parts.append(f"last AS MATERIALIZED {near(f'c{rounds}')}")
    return ("WITH " + ",\n".join(parts) + f"""
SELECT vec_id, last.c::INTEGER AS cluster, dist AS distance, (sum(dist) OVER (PARTITION BY last.c))::BIGINT AS cluster_inertia,
  (sum(dist) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM last JOIN c{rounds} ON last.c = c{rounds}.c""")


NS_KMEANS = ns_kmeans()
