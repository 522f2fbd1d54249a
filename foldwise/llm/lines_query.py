"""``op2_lines``: all documents without the lines that at least five of them share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm.common import table
from foldwise.llm.lines import drop_repeated_lines
from foldwise.llm.registry import query

SQL = r"""WITH lines AS (
  SELECT doc_id, unnest(range(1, len(parts) + 1)) AS nth, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, coalesce(k.doc_id <> r.last, false) AS gone FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query("op2_lines", SQL)
def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
