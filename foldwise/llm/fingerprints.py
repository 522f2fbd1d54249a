"""Order MinHash fingerprints: minimal occurrence-numbered k-mers, kept in text order.

A k-mer is ``k`` neighbouring words, and its occurrences in a text are numbered, so repeats count. The hash of (k-mer, number) puts each into
one of ``tuples * picks`` classes, and the smallest hash of each class is picked. The picks of ``picks`` classes, in the order in which they
stand in the text, are hashed to one entry of the fingerprint; where a class is empty, the next filled one lends its pick, so that entries
of short texts have an order too. Two texts share an entry if they share its picks in the same order; moved
text therefore counts as changed. All of it is DataFrame functions: occurrence numbers are a window within (text, k-mer), and the data
are dealt by text once, which serves the windows and all sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from foldwise.llm.common import tasks
from foldwise.sources.scratch import stored

#: words; what has no blanks for long is cut, so that a script without blanks has more than one word
WORDS = r"[^\x20\x09-\x0D]{1,16}"
LAST = (1 << 63) - 1


def kmers(text: Column, k: int) -> Column:
    """Hashes of all ``k`` neighbouring words in text order; of all words where there are fewer, none without words."""

    def all_of(words: Column) -> Column:
        at = F.sequence(F.lit(0), F.greatest(F.size(words) - k, F.lit(0)))
        hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
        return F.when(F.size(words) > 0, hashes).otherwise(F.array().cast("array<bigint>"))

    return F.element_at(F.transform(F.array(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))), all_of), 1)


def signatures(texts: DataFrame, keys: list[str], k: int = 3, tuples: int = 32, picks: int = 2) -> DataFrame:
    """(keys, signature): an array of ``tuples`` ints per row of ``texts`` (keys, text), whose keys are unique. A text of fewer k-mers than ``picks`` repeats them."""
    rows = texts.select(*keys, F.posexplode(kmers(F.col("text"), k)).alias("pos", "kmer"))
    number = F.row_number().over(W.partitionBy("kmer", *keys).orderBy("pos"))
    drawn = rows.select(*keys, "pos", F.xxhash64("kmer", number).alias("draw"))
    classed = drawn.withColumn("class", F.pmod("draw", F.lit(tuples * picks)).cast("int"))
    least = classed.groupBy(*keys, "class").agg(F.min("draw").alias("draw"), F.min_by("pos", "draw").alias("pos"))
    picked = least.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("class", "pos", "draw"))).alias("picked"))
    # around the end of the classes, as often as an entry needs
    around = picked.withColumn("around", F.flatten(F.array_repeat("picked", picks + 1)))

    def entry(j: Column) -> Column:
        before = F.when(F.size("picked") == tuples * picks, j * picks).otherwise(F.size(F.filter("picked", lambda p: p["class"] < j * picks)))
        mine = F.transform(F.slice("around", before + 1, picks), lambda p: F.struct(p["pos"].alias("pos"), p["draw"].alias("draw")))
        return F.shiftright(F.xxhash64(F.transform(F.sort_array(mine), lambda p: p["draw"])), 32).cast("int")

    return around.select(*keys, F.transform(F.sequence(F.lit(0), F.lit(tuples - 1)), entry).alias("signature"))


def likeness(a: str, b: str) -> Column:
    """The share of equal entries among those that either text has; 1 for two texts without words. A NULL signature has no entries."""
    pairs = F.arrays_zip(F.col(a).alias("a"), F.col(b).alias("b"))
    has = F.size(F.filter(pairs, lambda p: p["a"].isNotNull() | p["b"].isNotNull()))
    same = F.size(F.filter(pairs, lambda p: p["a"] == p["b"]))
    either = F.col(a).isNull() | F.col(b).isNull()
    return F.when(F.col(a).isNull() & F.col(b).isNull(), 1.0).when(either, 0.0).otherwise(same / has)


def text_form(signature: Column, tuples: int = 32) -> Column:
    """Eight hexadecimal digits per entry, ``-`` for one without picks."""
    digits = F.transform(signature, lambda x: F.coalesce(F.lpad(F.right(F.lower(F.hex(x.cast("long"))), F.lit(8)), 8, "0"), F.lit("-")))
    return F.when(signature.isNull(), "-" * tuples).otherwise(F.concat_ws("", digits))


def following(ids: DataFrame) -> DataFrame:
    """(doc, next_doc) for distinct ``ids`` (doc): the next larger one, after the largest the smallest.

    Ids are sorted by range and numbered within each; the last of a range looks to the first of the next, one row per range.
    """
    placed = stored(ids.repartitionByRange("doc").sortWithinPartitions("doc").withColumn("at", F.monotonically_increasing_id()), "ordered-ids")
    ranged = placed.withColumn("range", F.shiftright("at", 33))
    starts = ranged.groupBy("range").agg(F.min("doc").alias("start"))
    next_start = F.coalesce(F.lead("start").over(W.orderBy("range")), F.min("start").over(W.partitionBy()))
    starts = starts.select("range", next_start.alias("start"))
    behind = placed.select((F.col("at") - 1).alias("at"), F.col("doc").alias("lead"))
    return ranged.join(behind, "at", "left").join(starts, "range").select("doc", F.coalesce("lead", "start").alias("next_doc"))


def compared(docs: DataFrame, k: int = 3, tuples: int = 32, picks: int = 2) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document's are.

    ``docs`` needs doc_id and text; other columns are ignored. The edited text has its last floor(n / 4) code points replaced by the first as
    many of the next document by doc_id (after the last: the first). Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. A NULL text is empty; empty texts, and texts of blanks, have a fingerprint without entries and
    are alike. NULL ids come after all others. Where rows repeat a doc_id, one of them (the smallest hash of its text) is the next of the
    document before; equal rows give equal results, each its own row. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    plain = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    own = plain.select("doc", F.xxhash64("text").alias("hash"), "text")
    small = stored(own.select("doc", "hash", F.length("text").cast("long").alias("n_chars")), "lengths")
    size = small.agg(F.sum("n_chars")).first()[0] or 0
    many = small.groupBy("doc", "hash").agg(F.count("*").alias("rows"), F.first("n_chars").alias("n_chars"))
    heads = small.groupBy("doc").agg(F.min("hash").alias("next_hash"))
    order = following(heads.select("doc")).join(heads.withColumnRenamed("doc", "next_doc"), "next_doc")
    wanted = stored(many.join(order, "doc").select("doc", "hash", "rows", "n_chars", "next_doc", "next_hash"), "next-documents")

    dealt = own.repartition(tasks(spark, size, 4e6), "doc", "hash")
    if wanted.filter("rows > 1").limit(1).count():  # equal rows count once until the end
        nth = F.row_number().over(W.partitionBy("doc", "hash").orderBy("doc"))
        dealt = dealt.withColumn("nth", nth).filter("nth = 1").drop("nth")
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    heads_of = dealt.withColumnsRenamed({"doc": "next_doc", "hash": "next_hash", "text": "next_text"})
    first = wanted.join(heads_of, ["next_doc", "next_hash"]).select("doc", "hash", "n_chars", F.substring("next_text", F.lit(1), quarter).alias("first"))
    both = dealt.join(first, ["doc", "hash"])
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - quarter).cast("int")), F.col("first"))
    both = both.select("doc", "hash", "text", edited.alias("edited"))
    sides = both.select("doc", "hash", F.posexplode(F.array("text", "edited")).alias("side", "text"))
    signed = signatures(sides, ["doc", "hash", "side"], k, tuples, picks)
    shas = both.select("doc", "hash", F.sha2("edited", 256).alias("edited_sha256"))
    side = lambda n: F.max_by("signature", F.when(F.col("side") == n, 1))
    signed = signed.groupBy("doc", "hash").agg(side(0).alias("signature"), side(1).alias("edited"))
    done = stored(shas.join(signed, ["doc", "hash"], "left"), "signatures")

    after = done.select(F.col("doc").alias("next_doc"), F.col("hash").alias("next_hash"), F.col("signature").alias("next"))
    result = wanted.join(done, ["doc", "hash"]).join(after, ["next_doc", "next_hash"])
    rows = result.select("*", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("nth"))
    return rows.select(
        F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        text_form(F.col("signature"), tuples).alias("fingerprint"),
        text_form(F.col("edited"), tuples).alias("edited_fingerprint"),
        likeness("signature", "edited").alias("near_edited"),
        likeness("signature", "next").alias("near_next"),
    )
