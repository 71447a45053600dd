"""SQL for DuckDB that gives the rows of those operators that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op1_exact_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""

# Sizes and targets as in the contract; a source takes whole turns of its stream and the
# first blocks of one more, so its schedule is needed only as a number of slots.
ORACLES["op3_source_mixing"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS key,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM d GROUP BY source),
w AS (
    SELECT *, [5.0::DOUBLE, 2.0, 1.0][((place - 1) % 3 + 1)::INTEGER] AS weight,
           2.0::DOUBLE * source_size AS cap
    FROM s),
-- Share out by weight; cap what is above; share the rest again among the others.
turns AS (
    SELECT 0 AS turn, place, false AS capped,
           1.5::DOUBLE * (SELECT sum(source_size) FROM w) / (SELECT sum(weight) FROM w) AS level
    FROM w
    UNION ALL
    SELECT * FROM (
        SELECT turn + 1, place, now,
               (1.5::DOUBLE * sum(w.source_size) OVER ()
                - coalesce(sum(cap) FILTER (WHERE now) OVER (), 0))
               / nullif(coalesce(sum(weight) FILTER (WHERE NOT now) OVER (), 0), 0)
        FROM (SELECT t.turn, t.place, t.capped, t.level,
                     t.capped OR w.cap <= w.weight * t.level AS now
              FROM turns t JOIN w USING (place)) x JOIN w USING (place)
        QUALIFY bool_or(now <> capped) OVER ())),
last AS (SELECT * FROM turns QUALIFY turn = max(turn) OVER ()),
goal AS (
    SELECT w.source, w.source_size, w.place,
           CASE WHEN l.capped THEN cap ELSE weight * l.level END AS target
    FROM w JOIN last l USING (place)),
cum AS (
    SELECT *, sum(target) OVER (ORDER BY place) / nullif(sum(target) OVER (), 0) AS high,
           coalesce(sum(target) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           / nullif(sum(target) OVER (), 0) AS low
    FROM goal),
slot AS (
    SELECT n, x - floor(x) AS pos FROM (
        SELECT n, ((n % 1048576)::DOUBLE * 0.6180339887498949::DOUBLE
                   - floor((n % 1048576)::DOUBLE * 0.6180339887498949::DOUBLE))
               + ((n // 1048576)::DOUBLE * 0.7087122380733490::DOUBLE
                  - floor((n // 1048576)::DOUBLE * 0.7087122380733490::DOUBLE)) AS x
        FROM range((SELECT ceil(coalesce(sum(target), 0) / 64)::BIGINT FROM goal)) r(n))),
taken AS (
    SELECT source, place,
           least(count(*), 2 * ceil(any_value(source_size) / 64)::BIGINT) AS slots
    FROM slot JOIN cum ON pos >= low AND (pos < high OR high = (SELECT max(high) FROM cum))
         AND high > low
    GROUP BY source, place),
placed AS (
    SELECT d.*, g.source_size, g.target, coalesce(t.slots, 0) AS slots,
           ceil(g.source_size / 64)::BIGINT AS blocks,
           (sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS begin
    FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source
    LEFT JOIN taken t ON t.place = g.place
    WHERE size > 0
    UNION ALL
    SELECT d.*, g.source_size, g.target, 0, 1, 0
    FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source WHERE size = 0)
SELECT doc_id, size, source_size, target,
       (slots // blocks * size
        + greatest(0, least(begin + size, slots % blocks * 64) - begin))::BIGINT AS taken
FROM placed
"""

ORACLES["op6_minhash_neardup"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS words
    FROM documents),
s AS (
    SELECT doc_id, list_distinct(CASE
               WHEN len(words) = 0 THEN []
               WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
               ELSE list_transform(range(1, len(words) - 3),
                                   lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingles
    FROM w),
kinds AS (
    SELECT md5(array_to_string(list_sort(shingles), chr(10))) AS kind, min(doc_id) AS node,
           any_value(shingles) AS shingles, any_value(len(shingles)) AS n
    FROM s WHERE len(shingles) > 0 GROUP BY kind),
one AS (SELECT node, n, unnest(shingles) AS shingle FROM kinds),
edges AS (
    SELECT a.node AS a, b.node AS b
    FROM one a JOIN one b ON a.shingle = b.shingle AND a.node < b.node
    GROUP BY a.node, b.node, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
reach AS (
    SELECT node AS a, node AS b FROM kinds
    UNION
    SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
component AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a),
of AS (
    SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles,
           CASE WHEN len(s.shingles) = 0 THEN s.doc_id ELSE c.component END AS component_id
    FROM s
    LEFT JOIN kinds k ON len(s.shingles) > 0
         AND k.kind = md5(array_to_string(list_sort(s.shingles), chr(10)))
    LEFT JOIN component c ON c.node = k.node)
SELECT *, doc_id = component_id AS kept FROM of
"""

ORACLES["op7_warc_chunks"] = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
g AS (
    SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes,
           sha1(payload) AS payload_digest
    FROM p),
h AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS latest,
    FROM g)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND latest <> page_id THEN 'revisit' ELSE 'response' END
           AS record_type,
       CASE WHEN payload_bytes >= 1000 AND latest <> page_id THEN latest END AS refers_to
FROM h
"""

ORACLES["op9_decontamination"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS size,
           unnest(list_transform(range(1, greatest(2, len(words) - 8)),
                                 lambda i: array_to_string(words[i:i + 9], ' '))) AS part
    FROM b WHERE len(words) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
    FROM d JOIN sizes ON size <= len(words)),
runs AS (
    SELECT doc_id, size, pos, array_to_string(words[pos:pos + size - 1], ' ') AS part FROM places),
found AS (
    SELECT r.doc_id, r.size, r.pos, w.item_id FROM runs r JOIN windows w
    ON r.size = w.size AND r.part = w.part),
hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
        SELECT DISTINCT doc_id, unnest(range(pos, pos + size)) AS place FROM found)
    GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (
        SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found)
    GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op11_digest_index"] = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
           row_number() OVER () AS row
    FROM documents),
g AS (
    SELECT *, first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM d WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST, row))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
"""

# Every pair of sources over every kept term, without a tree and without zero shares apart.
ORACLES["op12_source_divergence"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
used AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
kept AS (
    SELECT lang, term, count(*) AS n FROM used GROUP BY lang, term
    HAVING count(DISTINCT row) >= 3),
per AS (
    SELECT lang, source, term, count(*) AS n FROM used JOIN kept USING (lang, term)
    GROUP BY lang, source, term),
langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
groups AS (
    SELECT g.lang, g.source, coalesce(t.n, 0) AS n
    FROM (SELECT DISTINCT lang, source FROM d) g
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM per GROUP BY lang, source) t
         USING (lang, source)),
p AS (
    SELECT g.lang, g.source, k.term, coalesce(per.n, 0) AS n,
           (1 + 1000000000::HUGEINT * (coalesce(per.n, 0) + 1) // (g.n + l.v)::HUGEINT) AS p,
           (1 + 1000000000::HUGEINT * (k.n + 1) // (l.n + l.v)::HUGEINT) AS q
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
    LEFT JOIN per ON per.lang = g.lang AND per.source = g.source AND per.term = k.term),
pairs AS (
    SELECT a.lang, a.source, b.source AS item,
           sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL),
every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part
                                 ORDER BY value DESC, encode(item)) AS rank FROM every)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""

# All pairs of equal words at most a quarter of the text apart; what lies next to each other at
# one distance is a stretch, and of stretches over the same words the shortest period counts.
ORACLES["op13_periodic_runs"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, byte: list_reduce(
                   list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda x, step: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT
                                                    ELSE 0::BIGINT END)))) AS h
    FROM documents),
plan AS (
    SELECT *, len(words)::BIGINT AS n,
           CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a
    FROM d),
w AS (
    SELECT row, n, i, words[1 + CASE WHEN a IS NULL OR i < a THEN i
                                     ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END
                           ] AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM plan)),
stretch AS (
    SELECT row, q, min(i) AS s, max(i) + 1 + q AS e FROM (
        SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM (
            SELECT x.row, x.i, y.i - x.i AS q
            FROM w x JOIN w y ON x.row = y.row AND x.word = y.word AND y.i > x.i
                             AND 4 * (y.i - x.i) <= x.n))
    GROUP BY row, q, island HAVING max(i) + 1 + q - min(i) >= greatest(6, 4 * q)),
run AS (
    SELECT * FROM stretch r WHERE NOT EXISTS (
        SELECT 1 FROM stretch o WHERE o.row = r.row AND o.q < r.q AND o.s <= r.s AND o.e >= r.e)),
listed AS (
    SELECT row, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), ''
                                               ORDER BY s, q) AS lines,
           arg_min(struct_pack(s := s, length := e - s, q := q),
                   struct_pack(short := s - e, s := s, q := q)) AS top
    FROM run GROUP BY row),
kept AS (
    SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM w
    WHERE NOT EXISTS (SELECT 1 FROM run r WHERE r.row = w.row AND w.i >= r.s + r.q AND w.i < r.e)
    GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.s::BIGINT AS start,
       top.length::BIGINT AS length, top.q::BIGINT AS period,
       (1000 * top.length // top.q)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (row) LEFT JOIN kept USING (row)
"""
