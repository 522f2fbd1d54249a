"""``op13_ranked``: the ten best documents for every benchmark item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foldwise.llm.common import table
from foldwise.llm.ranked import ranked
from foldwise.llm.registry import query

SQL = r"""WITH held AS (
  SELECT row_number() OVER () AS d, doc_id, text FROM documents
), asked AS (
  SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)
), postings AS (
  SELECT d, doc_id, term, count(*)::BIGINT AS tf FROM (
    SELECT d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM held)
  GROUP BY ALL
), lengths AS (
  SELECT d, sum(tf)::BIGINT AS n FROM postings GROUP BY d
), corpus AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM lengths
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, corpus GROUP BY term
), wanted AS (
  SELECT i, item_id, term, count(*)::BIGINT AS times FROM (
    SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM asked)
  GROUP BY ALL
), scores AS (
  SELECT i, item_id, p.d, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total))))::BIGINT AS score
  FROM wanted JOIN postings p USING (term) JOIN weights USING (term) JOIN lengths l ON l.d = p.d, corpus
  GROUP BY i, item_id, p.d, doc_id HAVING score > 0
)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM scores QUALIFY rank <= 10"""


@query("op13_ranked", SQL)
def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
