"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from loadlens.llm.hash_tree import BIN_ROWS, Node, even_tree, with_shard

#: crc32 of a blob: the 256-entry table from its rule, then one step a byte.
CRC_TABLE = """
WITH RECURSIVE step(b, c, k) AS (
  SELECT b, b::UBIGINT, 0 FROM range(256) r(b)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8
)
SELECT list(c ORDER BY b) AS t FROM step WHERE k = 8
"""


def _draw(name: str, weight: float) -> str:
    return f"-ln((('0x' || substr(md5(key || '|{name}'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / {weight}"


def _descend(node: Node) -> str:
    if not node.children:
        return str(node.shard)
    if len(node.children) == 1:
        return _descend(node.children[0])
    draws = [_draw(c.name, c.weight) for c in node.children]
    cases = " ".join(
        "WHEN " + " AND ".join(f"({d}) {'<=' if j > i else '<'} ({draws[j]})" for j in range(len(draws)) if j != i)
        + f" THEN {_descend(c)}" for i, c in enumerate(node.children) for d in [draws[i]])
    return f"CASE {cases} END"


_TREE = even_tree(2, 2, 2)

OP9 = f"""
WITH crc AS ({CRC_TABLE}),
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS key, coalesce(text, '') AS text FROM documents),
b AS (
  SELECT doc_id, strlen(text)::BIGINT + 1 AS size,
    xor(list_reduce(list_prepend(4294967295::UBIGINT,
        [('0x' || x)::UBIGINT FOR x IN regexp_extract_all(hex(encode(text)), '..')]),
      lambda c, x: xor(c >> 8, crc.t[((xor(c, x)) & 255)::INTEGER + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32,
    ({_descend(_TREE)})::INTEGER AS shard, ({_descend(with_shard(_TREE, 8))})::INTEGER AS grown_shard,
    ('0x' || substr(md5(key || '|' || text_crc32 || '|' || size || '|bin'), 1, 13))::BIGINT % ((SELECT count(*) FROM documents) // {BIN_ROWS} + 1) AS bin
  FROM d, crc
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY bin, doc_id, text_crc32, size) - 1)::BIGINT AS slot, grown_shard
FROM b
"""



def _lloyd(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Assignment and renewal as a chain of tables; the distance without the part's own square, which is added where it is reported."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS MATERIALIZED (
  SELECT r, s AS part, list_slice(v, s * (len(v) // {parts}) + 1, (s + 1) * (len(v) // {parts})) AS x FROM kept, range({parts}) t(s)
),
c0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id NULLS LAST, v) - 1 AS entry, x AS c
  FROM p JOIN (SELECT r, vec_id, v FROM kept ORDER BY vec_id NULLS LAST, v LIMIT {entries}) USING (r)
)"""]
    assign = """
a{k} AS MATERIALIZED (
  SELECT r, part, any_value(x) AS x, min(struct_pack(d := d, entry := entry)) AS best FROM (
    SELECT p.r, p.part, p.x, c.entry,
      (list_inner_product(c.c::DOUBLE[], c.c::DOUBLE[]) - 2 * list_inner_product(p.x::DOUBLE[], c.c::DOUBLE[])
       + list_inner_product(p.x::DOUBLE[], p.x::DOUBLE[]))::BIGINT AS d
    FROM p JOIN c{k} c USING (part)) GROUP BY r, part
)"""
    renew = """
c{n} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(m.c, c.c) AS c FROM c{k} c LEFT JOIN (
    SELECT part, entry, list(m ORDER BY i) AS c FROM (
      SELECT part, best.entry AS entry, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS m
      FROM a{k}, range(1, (SELECT max(len(x)) + 1 FROM p)) t(i) GROUP BY ALL) GROUP BY ALL) m
  ON c.part = m.part AND c.entry = m.entry
)"""
    for k in range(rounds):
        steps += [assign.format(k=k), renew.format(k=k, n=k + 1)]
    steps += [assign.format(k=rounds), f"""
e AS (SELECT r, string_agg(lpad(lower(to_hex(best.entry)), 2, '0'), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY r),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds})"""]
    return "WITH" + ",".join(steps) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN e USING (r), book
"""


OP11 = _lloyd()

_MARKS = {"a": "A", "b": "B", "c": "C", "d": "D", "e": "E"}

OP12 = f"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic,
    len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false) AS e
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
),
bits AS (
  SELECT part, {" + ".join(f"{1 << k} * {x}::INT" for k, x in enumerate(_MARKS))} AS bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM f GROUP BY ALL
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE length(p.x || q.x || r.x || s.x || t.x) = len(list_distinct([p.x, q.x, r.x, s.x, t.x]))
),
steps AS (
  SELECT filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS own,
    1 << (ascii(substr(filter_order, step::INT, 1)) - 65) AS ob,
    list_sum(list_transform(string_split(substr(filter_order, 1, step::INT - 1), ''), lambda x: CASE WHEN x = '' THEN 0 ELSE 1 << (ascii(x) - 65) END))::INT AS pb
  FROM orders, range(1, 6) g(step)
),
one AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN bits & (coalesce(pb, 0) | ob) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN bits & coalesce(pb, 0) = 0 AND bits & ob > 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN bits & coalesce(pb, 0) > 0 AND bits & ob > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN bits = ob THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN bits & coalesce(pb, 0) = 0 AND bits & ob > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN bits & coalesce(pb, 0) = 0 AND bits & ob > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM bits, steps GROUP BY ALL
)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM one
"""

OP13 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT *, strlen(html)::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM g
"""

ORACLE = {"op9_hash_tree_shards": OP9, "op11_resident_lloyd": OP11, "op12_filter_audit": OP12, "op13_warc": OP13}
