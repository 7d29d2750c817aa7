"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# CRC-32 byte by byte over a table built by its rule (reflected polynomial EDB88320)
SHARDING = """
WITH RECURSIVE bits(i, x, k) AS (
    SELECT i, i, 0 FROM range(256) t(i)
    UNION ALL
    SELECT i, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, k + 1 FROM bits WHERE k < 8
),
crc AS (SELECT list(x ORDER BY i) AS t FROM bits WHERE k = 8),
sized AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
        regexp_extract_all(hex(coalesce(text, '')::VARCHAR), '..') AS pairs
    FROM documents
),
summed AS (
    SELECT doc_id, size, xor(list_reduce(
        list_concat([4294967295::BIGINT], list_transform(pairs, lambda b: ('0x' || b)::BIGINT)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32
    FROM sized, crc
),
placed AS (
    SELECT *, sum(size) OVER everything - size AS start, sum(size) OVER () AS total, row_number() OVER everything AS place
    FROM summed WINDOW everything AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)
),
dealt AS (SELECT *, ((start * 16) // total)::INTEGER AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
    place - min(place) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard
FROM dealt
"""

EXACT = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY body)
"""


def _bits(use: str, value: str) -> str:
    return f"('0x' || substr(md5('{use}:0:' || {value}), 1, 15))::BIGINT"


def mixing() -> str:
    """Water filling, the permuted order with its prefix sums, and the tree of halves written out level by level."""
    levels, low_high = [], "SELECT *, 0 AS low, 16 AS high FROM draws"
    for level in range(4):
        name = "coalesce(source, '') || '/' || (source IS NULL)::VARCHAR || '/' || block || '/' || pass"
        levels.append(f"""
node{level} AS ({low_high}),
drawn{level} AS (
    SELECT *, low + (high - low) // 2 AS middle,
        row_number() OVER (PARTITION BY low, high ORDER BY {_bits(f'split{level}', name)}, source NULLS LAST, block, pass) AS nth,
        count(*) OVER (PARTITION BY low, high) AS quota
    FROM node{level}
)""")
        left = "nth <= quota * (middle - low) // (high - low)"
        low_high = (
            f"SELECT source, block, pass, CASE WHEN {left} THEN low ELSE middle END AS low, "
            f"CASE WHEN {left} THEN middle ELSE high END AS high FROM drawn{level}"
        )
    return f"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, len({WORDS})::BIGINT AS size,
        {_bits('place', "coalesce(doc_id::VARCHAR, '')")} AS key
    FROM documents
),
rows_ AS (SELECT *, key % 64 AS block, (key >> 6) % 1024 AS cell FROM sized),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM rows_ GROUP BY source
),
rounds(n, source, source_size, weight, capped, target) AS (
    SELECT 0, source, source_size, weight, false, 0.0::DOUBLE FROM sources
    UNION ALL
    SELECT n + 1, source, source_size, weight, capped OR level * weight > 3.0 * source_size,
        CASE WHEN capped THEN 3.0 * source_size ELSE level * weight END
    FROM (
        SELECT *, (sum(source_size) OVER () - sum(CASE WHEN capped THEN 3.0 * source_size ELSE 0 END) OVER ())
            / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS level
        FROM rounds WHERE n < 40
    )
),
goals AS (
    SELECT source, source_size, target,
        CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes
    FROM rounds WHERE n = 40
),
ordered AS (
    SELECT r.*, source_size, target, passes, target - passes * source_size AS rest,
        sum(size) OVER (PARTITION BY r.source ORDER BY block, cell, key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)
            - size AS before
    FROM rows_ r JOIN goals g ON r.source IS NOT DISTINCT FROM g.source
),
draws AS (
    SELECT source, block, unnest(range(max(passes) + 1)) AS pass FROM ordered GROUP BY source, block
),{",".join(levels)},
dealt AS ({low_high}),
plans AS (SELECT source, block, list(low ORDER BY pass) AS shards FROM dealt GROUP BY source, block),
taken AS (
    SELECT *, passes + (rest > 0 AND before + size / 2 <= rest AND (size > 0 OR before <= rest))::BIGINT AS copies FROM ordered
)
SELECT doc_id, size, source_size, target::DOUBLE AS target, (copies * size)::BIGINT AS taken,
    array_to_string(list_slice(shards, 1, copies), ',') AS shards
FROM taken t JOIN plans p ON t.source IS NOT DISTINCT FROM p.source AND t.block = p.block
"""


JACCARD = f"""
WITH RECURSIVE split AS (
    SELECT row_number() OVER () AS row_, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
),
shingle AS (
    SELECT DISTINCT row_, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
        ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS s
    FROM split
),
numbered AS (SELECT row_, dense_rank() OVER (ORDER BY s) AS s FROM shingle),
sizes AS (SELECT row_, count(*) AS n FROM numbered GROUP BY row_),
pairs AS (
    SELECT a.row_ AS a, b.row_ AS b, count(*) AS common
    FROM numbered a JOIN numbered b ON a.s = b.s AND a.row_ <> b.row_ GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM pairs JOIN sizes x ON a = x.row_ JOIN sizes y ON b = y.row_
    WHERE 100 * common >= 75 * (x.n + y.n - common)
),
reach(row_, to_) AS (
    SELECT row_, row_ FROM split
    UNION
    SELECT r.row_, l.b FROM reach r JOIN links l ON r.to_ = l.a
)
SELECT s.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(t.doc_id) AS component_id
FROM split s LEFT JOIN sizes USING (row_) JOIN reach r USING (row_) JOIN split t ON t.row_ = r.to_
GROUP BY s.row_, s.doc_id, n
"""

# CRC-32 of a text's bytes as above, of a column "s" of a relation "keys"
_CRC = """
bits(i, x, k) AS (
    SELECT i, i, 0 FROM range(256) t(i)
    UNION ALL
    SELECT i, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, k + 1 FROM bits WHERE k < 8
),
crc AS (SELECT list(x ORDER BY i) AS t FROM bits WHERE k = 8),
summed AS (
    SELECT s, xor(list_reduce(
        list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(s), '..'), lambda b: ('0x' || b)::BIGINT)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS sum_
    FROM keys, crc
)"""

TRIE = f"""
WITH RECURSIVE turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
lists AS (
    SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || ':' || text)) AS l
    FROM turns GROUP BY conv_id
),
keys AS (SELECT conv_id::VARCHAR AS s FROM lists),
{_CRC},
known AS (SELECT l.*, (sum_ % 6)::BIGINT AS h FROM lists l JOIN summed ON conv_id::VARCHAR = s),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.l, [])[1:h], c.l[h + 1:]) AS l
    FROM known c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 100
),
prefix AS (SELECT conv_id, len(l) AS n, unnest(range(len(l) + 1)) AS d, l FROM rebuilt),
nodes AS (
    SELECT d, l[1:d] AS p, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(length(l[d].t), 0) AS saved,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends
    FROM prefix GROUP BY d, l[1:d], l[d].t
),
born AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
grown AS (
    SELECT x.*, coalesce(n, 0) AS n_children FROM nodes x LEFT JOIN born y ON x.d = y.d AND x.p = y.p
),
lines AS (SELECT p[1:a] AS p, a AS d, n_children, saved FROM (SELECT *, unnest(range(d + 1)) AS a FROM grown)),
totals AS (
    SELECT d, p, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM lines GROUP BY d, p
)
SELECT x.conv_id, x.d::BIGINT AS depth, u.conv_id AS parent_conv_id, x.n_convs::BIGINT AS n_convs,
    x.n_children::BIGINT AS n_children, n_leaves, saved_tokens, x.ends AS ends_sha256
FROM grown x JOIN totals t ON x.d = t.d AND x.p = t.p LEFT JOIN nodes u ON u.d = x.d - 1 AND u.p = x.p[1:x.d - 1] AND x.d > 0
"""

# forward over the rows, the cheapest and then ASCII-least audit of each state; states 0 start, 1 s, 2 u, 3 a
REPAIR = f"""
WITH RECURSIVE keys AS (
    SELECT DISTINCT coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations
),
{_CRC},
faulty AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, sum_ % 20 AS k
    FROM conversations JOIN summed ON s = coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN k = 0 THEN [] WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM faulty
),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || ':' || text), copy) AS pos,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
    FROM damaged
),
marked AS (
    SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
        WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS i0
    FROM ordered
),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
        count(*) FILTER (WHERE fault = 'truncated') AS truncated, max(pos) AS n,
        count(*) FILTER (WHERE i0 IS NOT NULL AND i0 || i NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
),
inserts(state, to_, cost, letters, lines) AS (
    VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
        (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 2, 3, 'I', ['user:']),
        (1, 3, 6, 'II', ['user:', 'assistant:']), (2, 3, 3, 'I', ['assistant:']), (3, 2, 3, 'I', ['user:'])
),
writes(state, to_, role) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (2, 3, 'a'), (3, 2, 'u')),
options AS (
    SELECT m.conv_id, m.pos, w.state, w.to_,
        CASE WHEN i = w.role THEN 0 ELSE 3 END + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cost,
        CASE WHEN i = w.role THEN 'K' ELSE 'R' END AS letter,
        [CASE WHEN i = w.role THEN m.role WHEN w.role = 'u' THEN 'user' ELSE 'assistant' END || ':' || text] AS line
    FROM marked m, writes w WHERE fault NOT IN ('blank', 'duplicate') AND (w.role <> 's' OR i = 's')
    UNION ALL
    SELECT conv_id, pos, state, state, 4, 'D', []::VARCHAR[] FROM marked, range(4) t(state)
),
steps(conv_id, pos, state, cost, audit, lines) AS (
    SELECT conv_id, 0::BIGINT, to_, cost, letters, lines FROM counted, inserts WHERE state = 0
    UNION ALL
    SELECT conv_id, pos, to_, cost, audit, lines FROM (
        SELECT s.conv_id, o.pos, x.to_, s.cost + o.cost + x.cost AS cost, s.audit || o.letter || x.letters AS audit,
            list_concat(list_concat(s.lines, o.line), x.lines) AS lines,
            row_number() OVER (PARTITION BY s.conv_id, x.to_ ORDER BY s.cost + o.cost + x.cost, s.audit || o.letter || x.letters) AS nth
        FROM steps s JOIN options o ON s.conv_id IS NOT DISTINCT FROM o.conv_id AND o.pos = s.pos + 1 AND o.state = s.state
        JOIN inserts x ON x.state = o.to_
    ) WHERE nth = 1
),
best AS (
    SELECT s.conv_id, cost, audit, lines FROM steps s JOIN counted c ON s.conv_id IS NOT DISTINCT FROM c.conv_id
    WHERE pos = n AND state IN (0, 3)
    QUALIFY row_number() OVER (PARTITION BY s.conv_id ORDER BY cost, audit) = 1
)
SELECT d.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
    coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
    sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN counted c ON d.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON d.conv_id IS NOT DISTINCT FROM b.conv_id
"""

ORACLE = {
    "op3_byte_balanced_shards": SHARDING,
    "op5_content_sort_dedup": EXACT,
    "op6_hypergeometric_mix": mixing(),
    "op8_jaccard_tiles": JACCARD,
    "op11_rollup_trie": TRIE,
    "op13_block_table_repair": REPAIR,
}
