"""The queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from gridtally.llm import mixing

WORD = r"'[^\x20\x09-\x0D]+'"


def _mixing() -> str:
    draws = ", ".join(
        f"CAST(('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), "
        f"{8 * i + 1}, 8)) AS BIGINT) / 4294967296.0"
        for seed in mixing.SEEDS for i in range(4)
    )
    return f"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, {WORD})), 0) AS BIGINT) AS size,
         [{draws}] AS u
  FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS w,
         source_size * 2.0::DOUBLE AS room FROM per_source),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(room) OVER o, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
  FROM weighed
  WINDOW o AS (ORDER BY room / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size, CASE WHEN room < w * level THEN room ELSE least(room, w * coalesce(
    (SELECT arg_min(level, room / w) FROM levels WHERE room >= w * level), level)) END AS target
  FROM levels),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM goals),
each AS (
  SELECT d.*, r.source_size, r.target, floor(r.rate) AS whole, r.rate - floor(r.rate) AS part
  FROM sizes d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
tries AS (
  SELECT source, k, abs(any_value(target) - any_value(whole * source_size)
         - sum(CASE WHEN u[k] < part THEN size ELSE 0 END)) AS miss
  FROM each, range(1, {mixing.DRAWS} + 1) t(k) GROUP BY source, k),
chosen AS (SELECT source, min(struct_pack(miss := miss, k := k)).k AS k FROM tries GROUP BY source)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN u[k] < part THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM each e JOIN chosen c ON e.source IS NOT DISTINCT FROM c.source
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_source_mixing": _mixing()}
