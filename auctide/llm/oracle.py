"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WORDS = r"""len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"""

OP1 = f"""
WITH sizes AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source ASC NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sizes GROUP BY source),
steps AS (  -- water level at which a source is full
  SELECT *, 2.0 * source_size / weight AS full_at FROM per),
levels AS (  -- words handed out when the level stands where a source fills up
  SELECT a.full_at, sum(least(2.0 * b.source_size, b.weight * a.full_at)) AS given
  FROM steps a JOIN steps b ON true GROUP BY a.full_at),
base AS (
  SELECT coalesce(max(full_at), 0.0) AS lo FROM levels
  WHERE given <= 1.5 * (SELECT sum(source_size) FROM per)),
level AS (
  SELECT CASE WHEN sum(CASE WHEN full_at > lo THEN weight ELSE 0 END) > 0
         THEN (1.5 * sum(source_size) - sum(CASE WHEN full_at <= lo THEN 2.0 * source_size ELSE 0 END))
              / sum(CASE WHEN full_at > lo THEN weight ELSE 0 END)
         ELSE any_value(lo) END AS height
  FROM steps, base),
targets AS (
  SELECT source, source_size, least(2.0 * source_size, weight * height)::DOUBLE AS target FROM steps, level),
queued AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, floor(target)::BIGINT - start))
        + greatest(0, least(size, floor(target)::BIGINT - source_size - start)))::BIGINT AS taken
FROM queued
"""

_MARK = r"<\\*\|"

OP7 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
c AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
         len(regexp_extract_all(text, '{_MARK}')) + 2 * len(regexp_extract_all(role, '{_MARK}'))
         + length(role) - length(replace(replace(role, chr(92), ''), chr(10), ''))
         + 12 + length(role) + 1 + length(text) + 11 AS chars
  FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(length(loss))::BIGINT AS loss_chars,
       sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

OP4 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CASE WHEN label IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN embedding::DOUBLE[] END AS e
  FROM embeddings),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM v
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
comp AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
"""




def _nearest(vectors: str, books: str, name: str, by: str) -> str:
    """CTE ``name``: the number ``c`` and squared distance ``d`` of the nearest of ``books`` per row of ``vectors``."""
    return f"""
{name} AS (
  SELECT {by}, p, min(struct_pack(
      d := (list_inner_product(p, p) - 2 * list_inner_product(p, q) + list_inner_product(q, q))::BIGINT, c := c)) AS b
  FROM {vectors} JOIN {books} USING ({'part' if 'part' in by else 'one'}) GROUP BY ALL)"""


def _moved(found: str, books: str, name: str, key: str) -> str:
    """CTE ``name``: ``books`` after the floor of the mean of each entry's vectors."""
    on = "part, c" if key == "part" else "c"
    return f"""
{name}_x AS (
  SELECT {key}, b.c AS c, unnest(p)::BIGINT AS x, generate_subscripts(p, 1) AS i FROM {found}),
{name}_m AS (
  SELECT {key}, c, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::DOUBLE AS m
  FROM {name}_x GROUP BY ALL),
{name} AS (
  SELECT {key}, c, coalesce(n.q, o.q) AS q FROM {books} o
  LEFT JOIN (SELECT {on}, list(m ORDER BY i) AS q FROM {name}_m GROUP BY ALL) n USING ({on}))"""


def _integers(scale: int, more: str = "") -> str:
    return f"""v AS (
  SELECT row_number() OVER () AS rid, 1 AS one, vec_id, label,
         list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS p
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 {more})"""


def _op11() -> str:
    steps = [_integers(1024), """
parts AS (
  SELECT rid, unnest([0, 1, 2, 3]) AS part, p AS whole FROM v),
cut AS (
  SELECT rid, part, whole[part * len(whole) // 4 + 1 : (part + 1) * len(whole) // 4] AS p FROM parts),
firsts AS (
  SELECT rid, row_number() OVER (ORDER BY vec_id, p) - 1 AS c FROM v QUALIFY c < 256),
b0 AS (SELECT part, c, p AS q FROM cut JOIN firsts USING (rid))"""]
    for k in range(4):
        steps += [_nearest("cut", f"b{k}", f"a{k}", "rid, part"), _moved(f"a{k}", f"b{k}", f"b{k + 1}", "part")]
    steps += [_nearest("cut", "b4", "a4", "rid, part"), """
coded AS (
  SELECT rid, string_agg(lpad(lower(to_hex(b.c)), 2, '0'), '' ORDER BY part) AS code, sum(b.d)::BIGINT AS error
  FROM a4 GROUP BY rid),
books AS (
  SELECT sha256(string_agg(list_aggregate(list_transform(q, lambda x: x::BIGINT), 'string_agg', ','), ','
                           ORDER BY part, c)) AS codebooks_sha256 FROM b4)"""]
    return "WITH " + ",".join(steps) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM v JOIN coded USING (rid), books"""


def _op12() -> str:
    steps = [_integers(64, "AND len(embedding) = 64"), """
b0 AS (
  SELECT 1 AS one, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, 'null')), p) - 1 AS c, p AS q
  FROM v QUALIFY c < 16)"""]
    for k in range(3):
        steps += [_nearest("v", f"b{k}", f"a{k}", "rid, one"), _moved(f"a{k}", f"b{k}", f"b{k + 1}", "one")]
    steps += [_nearest("v", "b3", "a3", "rid, one"), """
names AS (
  SELECT c, sha256(list_aggregate(list_transform(q, lambda x: x::BIGINT), 'string_agg', ',')) AS centroid_sha256
  FROM b3)"""]
    return "WITH " + ",".join(steps) + """
SELECT vec_id, b.c::INTEGER AS cluster, b.d AS distance,
       (sum(b.d) OVER (PARTITION BY b.c))::BIGINT AS cluster_inertia, (sum(b.d) OVER ())::BIGINT AS inertia,
       centroid_sha256
FROM a3 JOIN v USING (rid) JOIN names ON names.c = b.c"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": OP1, "op4_embedding_dedup": OP4, "op7_chat_format": OP7,
            "op11_vector_codes": _op11(), "op12_centroid_clusters": _op12()}
