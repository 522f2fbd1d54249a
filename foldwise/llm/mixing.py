"""Mixing sources to target weights by nested thresholds on a hash of the document id.

Every document has a ticket of 60 bits. A source first gives all its documents ``floor(target / size)`` times; the rest of its
target is met by the documents whose ticket is below a threshold. The threshold is found without sorting documents: words are
summed by source and the ticket's first 12 bits, the bucket in which the sum crosses the budget is cut again by the next 12 bits,
and so on, and only the last boundary bucket is looked at ticket by ticket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from foldwise.llm.common import WORD
from foldwise.sources.scratch import stored

TICKET_BITS, LEVEL_BITS, LEVELS = 60, 12, 3
MOST_SOURCES = 100_000  # whose limits are sent to every executor


def ticket(column: str = "doc_id"):
    """60 bits of the MD5 of the id as text; a NULL id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, TICKET_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...], ceiling: int) -> DataFrame:
    """(source, source_size) -> target: ``least(ceiling * size, level * weight)`` at the level that uses up all words.

    Sources are few beside their documents; they are ordered by how soon they reach their ceiling, and the level is the first that
    the sources still below their ceiling can take. Sources are numbered by code point, NULL last.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    placed = sources.withColumn("place", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))).withColumn("weight", weight)
    top = placed.withColumn("top", F.col("source_size") * float(ceiling))
    before = W.orderBy(F.col("top") / F.col("weight"), "place").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levelled = top.withColumn("level", level)
    # the level rises over the sources that reach their ceiling and falls after them
    chosen = levelled.withColumn("level", F.max("level").over(everything))
    return chosen.select("source", "source_size", F.least("top", F.col("level") * F.col("weight")).alias("target"))


def mixture(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), ceiling: int = 3) -> DataFrame:
    """How often the mix takes each document: doc_id, source, size, source_size, target, copies, taken.

    ``docs`` needs doc_id, text and source; other columns are ignored. A NULL or empty text has size 0. Rows that repeat a doc_id have
    one ticket and are taken together; so are rows without an id. NULL is a source of its own. An empty table gives an empty table.
    A source misses its target by at most half of the words of the one ticket at its boundary. Reruns agree.
    """
    sizes = _sizes(docs)
    limits = _limits(sizes, weights, ceiling)
    return (
        sizes.join(limits, sizes["source"].eqNullSafe(limits["source"]), "left")
        .select("doc_id", sizes["source"], "size", "source_size", "target", _copies().alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def _sizes(docs: DataFrame) -> DataFrame:
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    return stored(docs.select("doc_id", "source", size.alias("size"), ticket().alias("ticket")), "mix-sizes")


def _copies():
    """How often a document is taken, from its ticket and its source's limits."""
    return (F.col("rounds") + F.when(F.col("ticket") <= F.col("threshold"), 1).otherwise(0)).cast("long")


def _limits(sizes: DataFrame, weights: tuple[float, ...], ceiling: int) -> DataFrame:
    """(source, source_size, target, rounds, rest, threshold): all that decides how often a document is taken, beside its ticket."""
    goals = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, ceiling)
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("rounds", rounds).withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    # (source, prefix of the ticket, words below that prefix), refined level by level
    at = stored(goals.withColumn("prefix", F.lit(0).cast("long")).withColumn("below", F.lit(0).cast("long")), "mix-goals")
    goals = at.select("source", "source_size", "target", "rounds", "rest")
    shift = TICKET_BITS
    for _ in range(LEVELS):
        within = sizes.withColumn("prefix", F.shiftrightunsigned("ticket", shift))
        cut = shift - LEVEL_BITS
        rows = _at_boundary(within, at).groupBy("source", F.shiftrightunsigned("ticket", cut).alias("prefix")).agg(F.sum("size").alias("words"))
        at = stored(_crossing(rows, at), "mix-boundary")
        shift = cut
    last = _at_boundary(sizes.withColumn("prefix", F.shiftrightunsigned("ticket", shift)), at)
    rows = last.groupBy("source", F.col("ticket").alias("prefix")).agg(F.sum("size").alias("words"))
    exact = _crossing(rows, at, keep_words=True)
    over, under = F.col("below") + F.col("words") - F.col("rest"), F.col("rest") - F.col("below")
    threshold = F.when((F.col("rest") > 0) & (over <= under), F.col("prefix")).otherwise(F.col("prefix") - 1)
    limits = exact.select("source", threshold.alias("threshold"))
    return stored(goals.join(limits, goals["source"].eqNullSafe(limits["source"]), "left").select(goals["*"], limits["threshold"]), "mix-limits")


def _at_boundary(rows: DataFrame, at: DataFrame) -> DataFrame:
    same = rows["source"].eqNullSafe(at["source"]) & (rows["prefix"] == at["prefix"])
    return rows.join(at, same, "left_semi")


def _crossing(rows: DataFrame, at: DataFrame, keep_words: bool = False) -> DataFrame:
    """Per source, the first of its sums at which the running total reaches the rest of its target."""
    goals = at.select("source", "rest", "below")
    joined = rows.join(goals, rows["source"].eqNullSafe(goals["source"])).select(rows["*"], "rest", "below")
    order = W.partitionBy("source").orderBy("prefix")
    total = F.col("below") + F.sum("words").over(order.rowsBetween(W.unboundedPreceding, 0))
    reached = joined.withColumn("total", total).filter(F.col("total") >= F.col("rest"))
    first = reached.withColumn("nth", F.row_number().over(order)).filter("nth = 1")
    kept = first.select("source", "rest", "prefix", (F.col("total") - F.col("words")).alias("below"), "words")
    return kept if keep_words else kept.drop("words")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), ceiling: int = 3) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as ``mixture`` takes it, all columns kept.

    The limits of the sources go to all tasks and texts are not shuffled; only where sources are too many for that, documents are joined with
    their limits by source.
    """
    limits = _limits(_sizes(docs), weights, ceiling).select(F.col("source").alias("__source"), "rounds", "threshold")
    limits = limits.withColumnsRenamed({c: f"__{c}" for c in ("rounds", "threshold")})
    limits = F.broadcast(limits) if limits.count() <= MOST_SOURCES else limits
    copies = (F.col("__rounds") + F.when(ticket() <= F.col("__threshold"), 1).otherwise(0)).cast("int")
    joined = docs.join(limits, docs["source"].eqNullSafe(limits["__source"]))
    taken = joined.withColumn("__copies", copies).filter("__copies > 0")
    return taken.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__nth")).drop("__nth")
