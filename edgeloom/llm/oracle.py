"""The operators' queries as DuckDB SQL, where SQL can express them on whole tables.

Language identification, toxicity and piece sampling are models; the main text of a page
takes an HTML parser. Their tests hold them against brute force and held-out rows.
"""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
BLANK_CLASS = r"[\x20\x09-\x0D]"



def _crc_byte() -> str:
    """CRC-32 of one more byte ``x`` from the value ``c``, by two half bytes."""
    table = []
    for i in range(16):
        for _ in range(4):
            i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)

    def half(c: str) -> str:
        return f"xor(({c}) >> 4, (CAST({table} AS BIGINT[]))[CAST(({c}) & 15 AS INT) + 1])"

    return half(half("xor(c, x)"))


SHARDING = """
WITH RECURSIVE
walk(doc_id, k, b, j, shard, grown) AS (
  SELECT doc_id, CAST(coalesce(doc_id, 0) AS HUGEINT), CAST(-1 AS BIGINT), CAST(0 AS BIGINT),
         CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  FROM (SELECT DISTINCT doc_id FROM documents)
  UNION ALL
  SELECT doc_id, k2, j,
         CAST(floor(CAST(j + 1 AS DOUBLE)
              * (CAST(2147483648 AS DOUBLE) / CAST(k2 // 8589934592 + 1 AS DOUBLE))) AS BIGINT),
         CASE WHEN j < 16 THEN j ELSE shard END, j
  FROM (SELECT *, (k * CAST(2862933555777941757 AS HUGEINT) + 1)
                  % CAST(18446744073709551616 AS HUGEINT) AS k2
        FROM walk WHERE j < 17)),
jumped AS (SELECT doc_id, max(shard) AS shard, max(grown) AS grown FROM walk GROUP BY doc_id),
digits AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (
  SELECT r, doc_id, length(h) // 2 AS n,
         list_transform(range(length(h) // 2), lambda i:
           CAST((instr('0123456789ABCDEF', substr(h, CAST(2 * i + 1 AS INT), 1)) - 1) * 16
                + instr('0123456789ABCDEF', substr(h, CAST(2 * i + 2 AS INT), 1)) - 1 AS BIGINT)) AS b
  FROM digits),
sums AS (
  SELECT r, doc_id, CAST(n + 1 AS BIGINT) AS size,
         CASE WHEN n = 0 THEN 0 ELSE
           xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, b),
             lambda c, x: CRC_BYTE))
         END AS crc
  FROM bytes)
SELECT s.doc_id, s.size, CAST(s.crc AS BIGINT) AS text_crc32, 'key' AS law,
       CAST(j.shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY j.shard ORDER BY s.doc_id NULLS FIRST, s.size, s.crc) - 1 AS slot,
       CAST(j.grown AS INTEGER) AS grown_shard
FROM sums s JOIN jumped j ON s.doc_id IS NOT DISTINCT FROM j.doc_id
""".replace("CRC_BYTE", _crc_byte())

LINE_DEDUP = """
WITH numbered AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents),
lines AS (
  SELECT r, doc_id, len(l) AS n, unnest(l) AS line, unnest(range(len(l))) AS pos FROM numbered),
keyed AS (SELECT *, """ + LOWER.format(f"trim(line, {BLANKS})") + """ AS k FROM lines),
repeated AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT keyed.*, repeated.k IS NOT NULL AND doc_id <> holder AS gone
  FROM keyed LEFT JOIN repeated ON keyed.k = repeated.k)
SELECT any_value(doc_id) AS doc_id, CAST(any_value(n) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""

EXACT_DEDUP = f"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '{BLANK_CLASS}', '', 'g') AS t
  FROM documents),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY t) AS n,
         first_value(doc_id) OVER (PARTITION BY t ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         row_number() OVER (PARTITION BY t ORDER BY chars DESC, doc_id NULLS LAST) AS pos
  FROM bare)
SELECT doc_id, keep_id, CAST(n AS BIGINT) AS group_size, pos = 1 AS kept, sha256(t) AS text_sha256
FROM ranked
"""

JACCARD = f"""
WITH RECURSIVE
words AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i:
      array_to_string(w[i : i + 3], ' '))) END AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, m.component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) m
  ON sets.doc_id = m.doc_id
"""

DECONTAMINATION = f"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")},
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i:
           array_to_string(w[i : i + least(10, len(w)) - 1], ' '))) AS shingle
  FROM item_words WHERE len(w) > 0),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")},
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
doc_windows AS (
  SELECT r, size, unnest(range(1, len(w) - size + 2)) AS pos,
         unnest(list_transform(range(1, len(w) - size + 2), lambda i:
           array_to_string(w[i : i + size - 1], ' '))) AS shingle
  FROM doc_words, sizes WHERE len(w) >= size),
found AS (SELECT r, pos, d.size, item_id FROM doc_windows d JOIN windows v
          ON d.size = v.size AND d.shingle = v.shingle),
hits AS (
  SELECT r, count(DISTINCT word) AS n FROM (
    SELECT r, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY r),
items AS (
  SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (
    SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hits.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       hits.n IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN hits ON doc_words.r = hits.r LEFT JOIN items ON doc_words.r = items.r
"""


def _clustering(dims: int, k: int, rounds: int) -> str:
    """Lloyd's rounds, one after the other."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept)
  ORDER BY h, v LIMIT {k})""",
    ]
    for now in range(rounds + 1):
        parts.append(f"""a{now} AS MATERIALIZED (
  SELECT r, vec_id, v, c, d FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place FROM (
      SELECT r, vec_id, kept.v, c, CAST(list_sum(list_transform(range(1, {dims + 1}),
        lambda i: (kept.v[i] - c{now}.v[i]) * (kept.v[i] - c{now}.v[i]))) AS BIGINT) AS d
      FROM kept, c{now}))
  WHERE place = 1)""")
        if now < rounds:
            parts.append(f"""c{now + 1} AS MATERIALIZED (
  SELECT old.c, coalesce(new.v, old.v) AS v FROM c{now} old LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n FROM (
        SELECT c, unnest(v) AS x, unnest(range({dims})) AS i FROM a{now})
      GROUP BY c, i)
    GROUP BY c) new ON old.c = new.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} f ON a.c = f.c
"""


CLUSTERING = _clustering(64, 40, 5)


def _cheapest(state: int) -> str:
    """The best edit of row ``i`` in a grammar state but insertion; ``s`` has the rest's best."""
    role_after = {0: 2, 1: 2, 2: 3, 3: 2}[state]
    initials = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state]
    stays = "fault NOT IN (1, 2)"
    edits = [f"[{{'c': 2 + s[{state + 1}].c, 'a': 'D' || s[{state + 1}].a}}]"]
    for initial, after in initials.items():
        edits.append(
            f"CASE WHEN {stays} AND initial = '{initial}' THEN "
            f"[{{'c': late + s[{after + 1}].c, 'a': 'K' || s[{after + 1}].a}}] ELSE [] END"
        )
    edits.append(
        f"CASE WHEN {stays} THEN "
        f"[{{'c': 1 + late + s[{role_after + 1}].c, 'a': 'R' || s[{role_after + 1}].a}}] ELSE [] END"
    )
    return f"list_sort({' || '.join(edits)})[1]"


def _inserted(own: str, other: str) -> str:
    return f"list_sort([{own}, {{'c': 5 + ({other}).c, 'a': 'I' || ({other}).a}}])[1]"


CONVERSATIONS = """
WITH RECURSIVE
stated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
           || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS b
  FROM conversations),
lots AS (
  SELECT *, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, b),
              lambda c, x: CRC_BYTE)) % 20 AS lot
  FROM stated),
damaged AS (
  SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
         CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN lot = 3 THEN [0, 1] ELSE [0] END) AS twin
  FROM lots WHERE lot <> 0),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, left(role, 1) AS initial,
         rtrim(text, BLANKS) AS bare,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth
  FROM damaged),
signed AS MATERIALIZED (
  SELECT g, conv_id, turn, role, initial, text,
         row_number() OVER w AS i, lag(initial) OVER w AS before,
         CASE WHEN bare = '' THEN 1 WHEN nth > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3
              ELSE 0 END AS fault
  FROM numbered WINDOW w AS (PARTITION BY g ORDER BY turn NULLS FIRST, role, sha256(text), nth)),
counts AS MATERIALIZED (
  SELECT g, any_value(conv_id) AS conv_id, count(*) AS n,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM signed GROUP BY g),
steps(g, i, s) AS (
  SELECT g, n + 1, [{'c': 0, 'a': ''}, {'c': 10, 'a': 'II'}, {'c': 5, 'a': 'I'}, {'c': 0, 'a': ''}]
  FROM counts
  UNION ALL
  SELECT g, i, [FROM0, FROM1, w2, w3]
  FROM (SELECT *, W2_OR AS x2 FROM (
    SELECT g, i, BEST0 AS w0, BEST1 AS w1, BEST2 AS b2, BEST3 AS b3, INS2 AS w2, INS3 AS w3
    FROM (SELECT r.g, r.i, s, fault, initial, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS late
          FROM steps JOIN signed r ON r.g = steps.g AND r.i = steps.i - 1)))),
solved AS MATERIALIZED (SELECT g, s[1].c AS cost, s[1].a AS audit FROM steps WHERE i = 1),
edits AS (
  SELECT g, pos, edit, sum(CAST(edit <> 'I' AS INT)) OVER w AS i, sum(CAST(edit <> 'D' AS INT)) OVER w AS p
  FROM (SELECT g, unnest(string_split(audit, '')) AS edit, unnest(range(length(audit))) AS pos
        FROM solved WHERE audit <> '')
  WINDOW w AS (PARTITION BY g ORDER BY pos)),
placed AS (
  SELECT e.g, e.pos, e.p, e.edit, r.role, coalesce(r.text, '') AS text,
         max(CAST(e.p = 1 AND e.edit = 'K' AND r.initial = 's' AS INT)) OVER (PARTITION BY e.g) AS head
  FROM edits e LEFT JOIN signed r ON r.g = e.g AND r.i = e.i AND e.edit <> 'I'
  WHERE e.edit <> 'D'),
texts AS (
  SELECT g, string_agg(CASE WHEN edit = 'K' THEN role WHEN (p - head) % 2 = 1 THEN 'user'
                       ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos) AS t
  FROM placed GROUP BY g)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts ON o.conv_id IS NOT DISTINCT FROM counts.conv_id
LEFT JOIN solved ON solved.g = counts.g LEFT JOIN texts ON texts.g = counts.g
""".replace("CRC_BYTE", _crc_byte()).replace("BLANKS", BLANKS)
for _old, _new in {
    "FROM0": _inserted("w0", "x2"),
    "FROM1": _inserted("w1", "x2"),
    "W2_OR": "w2",
    "INS2": _inserted("b2", "b3"),
    "INS3": _inserted("b3", "b2"),
    **{f"BEST{q}": _cheapest(q) for q in range(4)},
}.items():
    CONVERSATIONS = CONVERSATIONS.replace(_old, _new)

# DuckDB has no SHA-1 and no base 32; both are left to the test against brute force.
ORACLE = {
    "op1_sharding": SHARDING,
    "op2_line_dedup": LINE_DEDUP,
    "op8_exact_dedup": EXACT_DEDUP,
    "op9_ngram_jaccard_join": JACCARD,
    "op10_decontamination": DECONTAMINATION,
    "op11_centroid_clustering": CLUSTERING,
    "op13_conversation_repair": CONVERSATIONS,
}
