"""DuckDB SQL for the queries that SQL can express."""

from shelfwise.llm.mixing import offset

OP1_SUBSTRING_DEDUP = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, words[i:i + 12] AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs)
), firsts AS (
  SELECT run, min(doc_id) AS first_doc FROM windows GROUP BY run
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i
  FROM windows JOIN firsts USING (run), (SELECT unnest(range(13)) AS k)
  WHERE first_doc < doc_id
), words AS (
  SELECT doc_id, i, words[i] AS word
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs)
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n_kept
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n_kept, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

OP10_LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents
), keyed AS (
  SELECT *, translate(
    regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS winner FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT doc_id, i, line, winner IS NOT NULL AND winner <> doc_id AS dropped
  FROM keyed LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP3_SOURCE_MIXING = rf"""
WITH docs AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM docs GROUP BY source
), swept AS (
  SELECT *, 2 * source_size AS most,
    (sum(2 * source_size) OVER earlier - 2 * source_size)::DOUBLE AS most_before,
    (sum(weight) OVER () - sum(weight) OVER earlier + weight)::DOUBLE AS weight_left,
    1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS wanted
  FROM sources
  WINDOW earlier AS (ORDER BY (2 * source_size)::DOUBLE / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), judged AS (
  SELECT *, most * weight_left <= (wanted - most_before) * weight AS is_full FROM swept
), level AS (
  SELECT (max(wanted) - coalesce(sum(most) FILTER (is_full), 0)::DOUBLE)
    / nullif(coalesce(sum(weight) FILTER (NOT is_full), 0), 0)::DOUBLE AS level
  FROM judged
), targets AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN most::DOUBLE ELSE weight::DOUBLE * level END AS target
  FROM judged, level
), placed AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0::DOUBLE END AS rate,
    row_number() OVER (PARTITION BY docs.source ORDER BY size, doc_id NULLS FIRST)::DOUBLE AS nth
  FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  least(floor(nth * rate + '{offset()!r}'::DOUBLE) - floor((nth - 1) * rate + '{offset()!r}'::DOUBLE), 2)::BIGINT
    * size AS taken
FROM placed
"""

OP5_URL_FILTER = r"""
WITH split AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), judged AS (
  SELECT *, '.' || host AS dotted FROM split
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN ends_with(dotted, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with(dotted, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with(dotted, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with(dotted, '.net') AND starts_with(path, '/') THEN 'net/'
  END AS rule
  FROM judged
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

OP8_DECONTAMINATION = r"""
WITH lowered AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', item_id, text FROM benchmark
), split AS (
  SELECT side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM lowered
), item_windows AS (
  SELECT DISTINCT id AS item_id, least(len(words), 13) AS size, words[i:i + least(len(words), 13) - 1] AS run
  FROM (
    SELECT *, unnest(range(1, greatest(len(words) - 11, least(len(words), 1) + 1))) AS i
    FROM split WHERE side = 'b'
  )
), sizes AS (
  SELECT DISTINCT size FROM item_windows
), doc_windows AS (
  SELECT id AS doc_id, size, i, words[i:i + size - 1] AS run
  FROM (
    SELECT *, unnest(range(1, len(words) - size + 2)) AS i
    FROM split, sizes WHERE side = 'd' AND len(words) >= size
  )
), found AS (
  SELECT doc_id, size, i, item_id FROM doc_windows JOIN item_windows USING (size, run)
), hits AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM (SELECT DISTINCT doc_id, size, i FROM found))
  GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT id AS doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM split LEFT JOIN hits ON hits.doc_id = id LEFT JOIN items ON items.doc_id = id
WHERE side = 'd'
"""

OP11_PHRASE_COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
  FROM documents
), phrases AS (
  SELECT lang, k, words[i:i + k - 1] AS phrase FROM (
    SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
    FROM pieces, (SELECT unnest(range(1, 5)) AS k) WHERE len(words) >= k)
), counts AS (
  SELECT lang, k, phrase, count(*)::BIGINT AS f FROM phrases GROUP BY lang, k, phrase HAVING f >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, c.cut, x.f AS l, y.f AS r,
    ((2000000::HUGEINT * c.f) // (x.f + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM counts) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = c.phrase[1:c.cut]
  JOIN counts y ON y.lang = c.lang AND y.phrase = c.phrase[c.cut + 1:]
), candidates AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_phrases AS (
  SELECT lang, phrase[i:i + n - 1] AS phrase, max(f) AS longer FROM (
    SELECT *, unnest(range(1, k - n + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS n FROM counts))
  GROUP BY ALL
), kept AS (
  SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, score
  FROM candidates LEFT JOIN inner_phrases USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < 80 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang) USING (lang)
WHERE rank <= 2000
"""

OP13_CONVERSATION_TRIE = r"""
WITH placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
    sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
    strlen(coalesce(text, ''))::BIGINT AS bytes
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  -- CRC-32 bit by bit: after each byte (0 or more) eight steps (-1).
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
    ), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM placed)
), given AS (
  SELECT c.conv_id, h, count(p.pos) AS k
  FROM convs c LEFT JOIN placed p ON p.conv_id = c.conv_id - c.conv_id % 5 AND p.pos <= h GROUP BY ALL
), rebuilt AS (
  SELECT g.conv_id, pos, said, bytes FROM given g JOIN placed p ON p.conv_id = g.conv_id - g.conv_id % 5 AND pos <= h
  UNION ALL
  SELECT g.conv_id, pos - h + k, said, bytes FROM given g JOIN placed p ON p.conv_id = g.conv_id AND pos > h
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs
), prefixes AS (
  SELECT conv_id, pos AS depth, bytes,
    sha256(string_agg(said, '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos)) AS node
  FROM rebuilt
), linked AS (
  SELECT *, lag(node) OVER w AS parent, lead(node) OVER w IS NULL AS ends
  FROM prefixes WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
), nodes AS (
  SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(bytes) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM linked GROUP BY node, depth
), counted AS (
  SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.parent = n.node AND c.depth = n.depth + 1) AS n_children FROM nodes n
), below AS (
  -- The nodes under a node, each once, by way of its least conversation.
  SELECT u.node, u.depth, sum(v.saved) AS saved_tokens, count(*) FILTER (v.n_children = 0) AS n_leaves
  FROM counted v JOIN linked l ON l.conv_id = v.conv_id AND l.depth <= v.depth
  JOIN counted u ON u.node = l.node AND u.depth = l.depth GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
  saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN below b ON b.node = n.node AND b.depth = n.depth
LEFT JOIN nodes p ON p.node = n.parent AND p.depth = n.depth - 1
"""

ORACLES = {
    "op1_substring_dedup": OP1_SUBSTRING_DEDUP,
    "op3_source_mixing": OP3_SOURCE_MIXING,
    "op5_url_filter": OP5_URL_FILTER,
    "op8_decontamination": OP8_DECONTAMINATION,
    "op10_line_dedup": OP10_LINE_DEDUP,
    "op11_phrase_collocations": OP11_PHRASE_COLLOCATIONS,
    "op13_conversation_trie": OP13_CONVERSATION_TRIE,
}
