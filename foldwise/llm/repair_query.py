"""``op11_repair``: damaged conversations, what is wrong with each, and the digest of its cheapest repair."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm.common import table
from foldwise.llm.registry import query
from foldwise.llm.repair import damage, repair

# turn by turn with the four states of the pattern: (cost, audit, text so far) after each
SQL = r"""WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_transform(range(0, 8 * length(k)), lambda i: (ascii(substr(k, (i // 8 + 1)::INT, 1)) >> (i % 8)::INT)::BIGINT & 1),
         lambda a, b: CASE WHEN (xor(a, b) & 1) = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END, 4294967295::BIGINT), 4294967295::BIGINT) % 20 AS way
  FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
         CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, unnest(CASE WHEN way = 3 THEN [0, 1] ELSE [0] END) AS t(copy) WHERE way <> 0
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged
), faulty AS (
  SELECT *, substr(role, 1, 1) AS c, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault,
         substr(role, 1, 1) || lead(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS two
  FROM ordered
), steps AS (
  SELECT conv_id, i, c, fault, role || ':' || text || chr(10) AS line, 'user:' || text || chr(10) AS u, 'assistant:' || text || chr(10) AS a,
         CASE fault WHEN 't' THEN 5 WHEN '' THEN 0 END AS more
  FROM faulty
), parse AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {'c': 0, 'a': '', 't': ''} AS s0, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS s1,
         {'c': 5, 'a': 'I', 't': 'user:' || chr(10)} AS s2, {'c': 10, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)} AS s3
  FROM steps
  UNION ALL
  SELECT conv_id, i, r0, r1, q2, list_min(list_filter([r3,
           CASE WHEN q2 IS NOT NULL THEN {'c': q2.c + 5, 'a': q2.a || 'I', 't': q2.t || 'assistant:' || chr(10)} END], lambda x: x IS NOT NULL))
  FROM (SELECT *, list_min(list_filter([r2,
           {'c': r0.c + 5, 'a': r0.a || 'I', 't': r0.t || 'user:' || chr(10)},
           CASE WHEN r1 IS NOT NULL THEN {'c': r1.c + 5, 'a': r1.a || 'I', 't': r1.t || 'user:' || chr(10)} END,
           CASE WHEN r3 IS NOT NULL THEN {'c': r3.c + 5, 'a': r3.a || 'I', 't': r3.t || 'user:' || chr(10)} END], lambda x: x IS NOT NULL)) AS q2
  FROM (SELECT p.conv_id, s.i,
      {'c': s0.c + 2, 'a': s0.a || 'D', 't': s0.t} AS r0,
      list_min(list_filter([CASE WHEN s1 IS NOT NULL THEN {'c': s1.c + 2, 'a': s1.a || 'D', 't': s1.t} END,
        CASE WHEN more IS NOT NULL AND s.c = 's' THEN {'c': s0.c + more, 'a': s0.a || 'K', 't': s0.t || line} END], lambda x: x IS NOT NULL)) AS r1,
      list_min(list_filter([{'c': s2.c + 2, 'a': s2.a || 'D', 't': s2.t},
        CASE WHEN more IS NOT NULL THEN {'c': s0.c + more + (s.c <> 'u')::INT, 'a': s0.a || CASE WHEN s.c = 'u' THEN 'K' ELSE 'R' END, 't': s0.t || CASE WHEN s.c = 'u' THEN line ELSE u END} END,
        CASE WHEN more IS NOT NULL AND s1 IS NOT NULL THEN {'c': s1.c + more + (s.c <> 'u')::INT, 'a': s1.a || CASE WHEN s.c = 'u' THEN 'K' ELSE 'R' END, 't': s1.t || CASE WHEN s.c = 'u' THEN line ELSE u END} END,
        CASE WHEN more IS NOT NULL THEN {'c': s3.c + more + (s.c <> 'u')::INT, 'a': s3.a || CASE WHEN s.c = 'u' THEN 'K' ELSE 'R' END, 't': s3.t || CASE WHEN s.c = 'u' THEN line ELSE u END} END], lambda x: x IS NOT NULL)) AS r2,
      list_min(list_filter([{'c': s3.c + 2, 'a': s3.a || 'D', 't': s3.t},
        CASE WHEN more IS NOT NULL THEN {'c': s2.c + more + (s.c <> 'a')::INT, 'a': s2.a || CASE WHEN s.c = 'a' THEN 'K' ELSE 'R' END, 't': s2.t || CASE WHEN s.c = 'a' THEN line ELSE a END} END], lambda x: x IS NOT NULL)) AS r3
    FROM parse p JOIN steps s ON s.conv_id IS NOT DISTINCT FROM p.conv_id AND s.i = p.i + 1))
), best AS (
  SELECT conv_id, list_min([s0, s3]) AS b FROM parse QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), counted AS (
  SELECT f.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty f GROUP BY f.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit,
       sha256(coalesce(CASE WHEN length(b.t) > 0 THEN substr(b.t, 1, length(b.t) - 1) END, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id"""


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): lines ``role:text`` of each conversation, whose turns follow each other in one partition."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, state = None, None
        for batch in batches:
            done = []
            for r in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))):
                if r[1] == 0:
                    if state is not None:
                        done.append((conversation, state.hexdigest()))
                    conversation, state = r[0], hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{r[2]}:{r[3]}".encode())
            kind = batch.schema.field("conv_id").type
            yield _digests(done, kind)
        if state is not None:
            yield _digests([(conversation, state.hexdigest())], kind)

    return turns.mapInArrow(digest, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")


def _digests(rows: list, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())], names=["conv_id", "repaired_sha256"])


@query("op11_repair", SQL)
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))


def repaired(conversations: DataFrame) -> DataFrame:
    """A row per conv_id of ``conversations``, damaged and repaired; one without rows after damage has zeros and the digest of nothing."""
    found, turns = repair(damage(conversations))
    sha = digests(turns).withColumnRenamed("conv_id", "c2")
    every = conversations.select("conv_id").distinct()
    known = found.withColumnRenamed("conv_id", "c1")
    joined = every.join(known, F.col("conv_id").eqNullSafe(F.col("c1")), "left").join(sha, F.col("conv_id").eqNullSafe(F.col("c2")), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256().hexdigest())
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
