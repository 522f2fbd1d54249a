"""``op3_mixing``: all documents mixed to the weights 5, 2, 1, no document more than three times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm.common import table
from foldwise.llm.mixing import mixture
from foldwise.llm.registry import query

#: common table expressions up to ``plan`` (doc_id, source, size, ..., copies) over a relation ``documents``
MIX_CTE = r"""sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS ticket
  FROM documents
), by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), placed AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         source_size * 3.0::DOUBLE AS top
  FROM by_source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(top) OVER w, 0.0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0.0)) AS level
  FROM placed
  WINDOW w AS (ORDER BY top / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
  SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS rounds FROM (
    SELECT source, source_size, least(top, weight * max(level) OVER ()) AS target FROM levels)
), running AS (
  SELECT g.*, ticket, words, target - rounds * source_size AS rest,
         sum(words) OVER (PARTITION BY g.source ORDER BY ticket) AS total
  FROM goals g JOIN (SELECT source, ticket, sum(size) AS words FROM sized GROUP BY source, ticket) t
    ON g.source IS NOT DISTINCT FROM t.source
), limits AS (
  SELECT source, CASE WHEN rest > 0 AND total - rest <= rest - (total - words) THEN ticket ELSE ticket - 1 END AS threshold
  FROM running WHERE total >= rest QUALIFY row_number() OVER (PARTITION BY source ORDER BY ticket) = 1
), plan AS (
  SELECT s.*, source_size, target, rounds + CASE WHEN s.ticket <= threshold THEN 1 ELSE 0 END AS copies
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
  LEFT JOIN limits l ON s.source IS NOT DISTINCT FROM l.source
)"""

SQL = f"""WITH {MIX_CTE}
SELECT doc_id, size, source_size, round(target, 4) + 0.0 AS target, (copies * size)::BIGINT AS taken FROM plan"""


@query("op3_mixing", SQL)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixture(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", (F.round("target", 4) + F.lit(0.0)).alias("target"), "taken")
