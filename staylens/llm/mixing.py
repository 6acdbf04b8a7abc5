"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

Targets share ``share`` times all words by weight; none exceeds ``repeat`` times its
source's words, and what one leaves is shared by weight among the others. Slot k of
the schedule is the point frac(k * golden ratio) mapped through the sources'
cumulative targets, so every stretch of slots holds the sources near their shares.
Each source's documents, in the order of the md5 of their ids, form a stream of
words cut into blocks of ``block_words``; the r-th slot of a source takes its block
r modulo its number of blocks. A document gives the words of its that lie in taken
blocks, once per time.

A hot source is never one group: positions in the stream are prefix sums in two
levels, within (source, md5 prefix) and over the prefixes' totals; ranks of slots
likewise within chunks of the schedule. Points find their source by an equi-join on
grid cells.

Cases: null texts have no words; a null source is one source, the last; documents
without words take none; repeated rows each have their place; an empty table gives
no rows; a corpus without words has targets of 0; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from staylens.llm.common import stored

WEIGHTS = (3, 1, 2)
GOLDEN = 0.6180339887498949
GRID = 1024
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, *, share: float = 1.5, repeat: float = 2.0) -> DataFrame:
    """From (source, source_size): ordinal, weight, target. One row per source, sorted in one task."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sizes.withColumn("ordinal", F.row_number().over(order)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                               ((F.col("ordinal") - 1) % len(WEIGHTS) + 1).cast("int")))
    cap = F.col("source_size") * repeat
    by_need = Window.orderBy(cap / F.col("weight"), "ordinal")
    before, after = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) * share - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    free = numbered.withColumn("level", level).withColumn("cap", cap)
    # the level of the first source that its cap does not stop is everyone's level
    open_at = F.min(F.when(F.col("cap") / F.col("weight") > F.col("level"),
                           F.struct(F.col("cap") / F.col("weight"), F.col("ordinal"), F.col("level")))).over(whole)
    return free.withColumn("common", open_at.getField("level")).select(
        "source", "source_size", "ordinal", "weight",
        F.when(F.col("common").isNull(), F.col("cap"))
        .otherwise(F.least(F.col("cap"), F.col("common") * F.col("weight"))).cast("double").alias("target"))


def slots(goals: DataFrame, total_slots: int, block_words: int, repeat: int = 2) -> DataFrame:
    """The schedule: slot, ordinal (source), rank, block, epoch."""
    spark = goals.sparkSession
    # every source's interval begins where the one before ends; the last ends at 1
    order = Window.orderBy("ordinal")
    upto = F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, 0))
    all_of = F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = goals.select("ordinal", "source_size", F.when(F.lead("ordinal").over(order).isNull(), F.lit(1.0))
                        .otherwise(upto / all_of).alias("hi"))
    spans = ends.withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0.0))).where("hi > lo")
    cells = spans.select("*", F.explode(F.sequence(F.floor(F.col("lo") * GRID), F.least(F.floor(F.col("hi") * GRID), F.lit(GRID - 1)))).alias("cell"))
    x = F.col("slot") * F.lit(GOLDEN)
    points = spark.range(total_slots).select(F.col("id").alias("slot")).select("slot", (x - F.floor(x)).alias("x")) \
        .withColumn("cell", F.floor(F.col("x") * GRID))
    placed = points.join(cells, "cell").where("x >= lo AND x < hi").select("slot", "ordinal", "source_size")
    chunk = max(4096, int(total_slots ** 0.5))
    placed = placed.withColumn("chunk", F.floor(F.col("slot") / chunk))
    counts = placed.groupBy("ordinal", "chunk").agg(F.count("*").alias("n"))
    offset = F.coalesce(F.sum("n").over(Window.partitionBy("ordinal").orderBy("chunk")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = placed.withColumn("own", F.row_number().over(Window.partitionBy("ordinal", "chunk").orderBy("slot")) - 1) \
        .join(counts.select("ordinal", "chunk", offset.alias("offset")), ["ordinal", "chunk"])
    n_blocks = F.ceil(F.col("source_size") / block_words)
    rank = F.col("offset") + F.col("own")
    return ranked.select("slot", "ordinal", rank.alias("rank"), (rank % n_blocks).alias("block"),
                         F.floor(rank / n_blocks).alias("epoch")).where(F.col("epoch") < repeat)


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        share: float = 1.5, repeat: int = 2, block_words: int = 64) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and source."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    sized = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"))
                   .withColumn("hash", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
                   .withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    prefix = F.substring("hash", 1, 3)
    sized = sized.withColumn("prefix", prefix)
    buckets = sized.groupBy("source", "prefix").agg(F.sum("size").alias("words"))
    goals = stored(targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), share=share, repeat=float(repeat)),
                   "mix-targets")
    total = goals.agg(F.sum("target")).first()[0] or 0.0
    schedule = slots(goals, round(total / block_words), block_words, repeat)
    uses = schedule.groupBy("ordinal", "block").agg(F.count("*").alias("times"))
    start = F.coalesce(F.sum("words").over(Window.partitionBy("ordinal").orderBy("prefix")
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    g = goals.withColumnRenamed("source", "of")
    places = buckets.join(g, buckets["source"].eqNullSafe(g["of"])).select(
        F.col("of"), F.col("prefix").alias("at"), "ordinal", "source_size", "target", start.alias("start"))
    own = Window.partitionBy("source", "prefix").orderBy("hash", "doc_id", "size", "row")
    placed = sized.withColumn("before", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")) \
        .join(places, F.col("source").eqNullSafe(F.col("of")) & (F.col("prefix") == F.col("at")))
    begin = F.col("start") + F.col("before")
    pieces = placed.select("row", "ordinal", begin.alias("b"), (begin + F.col("size")).alias("e")).where("e > b") \
        .select("row", "ordinal", "b", "e", F.explode(F.sequence(F.floor(F.col("b") / block_words), F.floor((F.col("e") - 1) / block_words))).alias("block"))
    words = F.least("e", (F.col("block") + 1) * block_words) - F.greatest("b", F.col("block") * block_words)
    taken = pieces.join(uses, ["ordinal", "block"]).groupBy("row").agg(F.sum(words * F.col("times")).alias("taken"))
    return placed.select("row", "doc_id", "source", "size", "source_size", "target").join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")
