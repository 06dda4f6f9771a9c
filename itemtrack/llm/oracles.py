"""DuckDB SQL of the queries that SQL can say."""

# CRC-32 of texts: a byte's share depends on its distance k from the end; shares of 256
# neighbouring bytes are xor-ed at once and the blocks are folded from the first to the last.
_CRC32 = """
bits AS (SELECT i AS byte, 0 AS step, i::BIGINT AS v FROM range(256) t(i)
    UNION ALL SELECT byte, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END
    FROM bits WHERE step < 8),
t AS (SELECT byte, v FROM bits WHERE step = 8),
near AS (SELECT byte, 0 AS k, v FROM t
    UNION ALL SELECT n.byte, n.k + 1, xor(t.v, n.v >> 8) FROM near n JOIN t ON t.byte = n.v & 255 WHERE n.k < 255),
far AS (SELECT j, byte, 0 AS k, byte::BIGINT << (8 * j) AS v FROM t, range(4) r(j)
    UNION ALL SELECT f.j, f.byte, f.k + 1, xor(t.v, f.v >> 8) FROM far f JOIN t ON t.byte = f.v & 255 WHERE f.k < 256),
skip AS (SELECT j, byte, v FROM far WHERE k = 256),
begin AS (SELECT 0 AS r, 4294967295 AS v
    UNION ALL SELECT r + 1, xor(t.v, b.v >> 8) FROM begin b JOIN t ON t.byte = b.v & 255 WHERE r < 256),
texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
    octet_length(encode(coalesce(text, ''))) AS len FROM documents),
hexes AS (SELECT byte, upper(printf('%02x', byte)) AS h FROM t),
octets AS (SELECT row, len, unnest(p) AS h, generate_subscripts(p, 1) - 1 AS place
    FROM (SELECT row, len, regexp_extract_all(hex(encode(text)), '..') AS p FROM texts WHERE len > 0)),
blocks AS (SELECT row, len, (len - 1 - place) // 256 AS m, bit_xor(near.v) AS v
    FROM octets JOIN hexes USING (h) JOIN near ON near.byte = hexes.byte AND near.k = (len - 1 - place) % 256
    GROUP BY ALL),
fold AS (SELECT b.row, b.m, xor(begin.v, b.v) AS v FROM blocks b JOIN begin ON begin.r = b.len - 256 * b.m
        WHERE b.m = (b.len - 1) // 256
    UNION ALL SELECT f.row, b.m, xor(xor(xor(s0.v, s1.v), xor(s2.v, s3.v)), b.v) FROM fold f
    JOIN blocks b ON b.row = f.row AND b.m = f.m - 1
    JOIN skip s0 ON s0.j = 0 AND s0.byte = f.v & 255 JOIN skip s1 ON s1.j = 1 AND s1.byte = (f.v >> 8) & 255
    JOIN skip s2 ON s2.j = 2 AND s2.byte = (f.v >> 16) & 255 JOIN skip s3 ON s3.j = 3 AND s3.byte = (f.v >> 24) & 255),
crc AS (SELECT row, xor(v, 4294967295) AS crc FROM fold WHERE m = 0)"""

SHARDING = f"""WITH RECURSIVE {_CRC32},
placed AS (SELECT x.doc_id, x.len + 1 AS size, coalesce(c.crc, 0) AS text_crc32, md5(x.text) AS digest,
    row_number() OVER o AS place, sum(x.len + 1) OVER o - (x.len + 1) AS before, sum(x.len + 1) OVER () AS total
    FROM texts x LEFT JOIN crc c ON c.row = x.row
    WINDOW o AS (ORDER BY md5(x.text), x.doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)),
grouped AS (SELECT *, min(before) OVER (PARTITION BY digest) AS start, sum(size) OVER (PARTITION BY digest) AS bytes
    FROM placed),
cut AS (SELECT *, least(15, CASE WHEN bytes * 16 <= total THEN 2 * start + bytes ELSE 2 * before + size END
    * 16 // (2 * total)) AS s FROM grouped)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, s::INTEGER AS shard,
    (place - min(place) OVER (PARTITION BY s))::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM cut"""


DECONTAMINATION = r"""WITH docs AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[s + 1 : s + 10], ' ') AS phrase
    FROM (SELECT item, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT row, size, s, array_to_string(w[s + 1 : s + size], ' ') AS phrase
    FROM (SELECT row, w, size, unnest(range(len(w) - size + 1)) AS s FROM docs, sizes WHERE len(w) >= size)),
found AS (SELECT p.row, p.s, p.size, w.item FROM places p JOIN windows w USING (size, phrase)),
hit AS (SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(range(s, s + size)) AS word
    FROM (SELECT DISTINCT row, s, size FROM found)) GROUP BY row),
named AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT row, item FROM found) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN named USING (row)"""
