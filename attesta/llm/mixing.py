"""Mixing sources to target weights by hash-threshold histograms.

Every row has a hash of its id. For a budget of words, a source takes the rows whose hash is
below a threshold, so a larger budget always takes a superset (nested budgets), and the choice
is a filter: nothing is sorted, and reruns agree. The threshold is found from histograms: sizes
are summed by source and hash bucket (a partial sum before the shuffle, so a hot source is no
hot task), the bucket in which the budget runs out is the boundary, and only its rows enter the
next, finer histogram, until the boundary is a single hash value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.runtime import durable, free, ranked

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, LEVEL_BITS = 60, 10
#: More sources than this and the thresholds are joined by shuffle; fewer are broadcast.
BROADCAST_SOURCES = 50_000


def words(text: Column) -> Column:
    """Number of runs of other characters than white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(*cols: Column) -> Column:
    """The first 60 bits of an MD5, as a long from 0: the same in any engine."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeat: float = 3.0) -> DataFrame:
    """(source, source_size) -> with target: the sources, by code point with null last, weigh
    ``weights`` repeating, and share the sum of all sizes; a target stops at ``max_repeat`` times
    its source's size and the excess is reshared by weight until none is above.

    The shares are found by the water level: target = least(cap, level * weight), where the level
    rises until the sources that it fills to the cap stay the same; each turn is one sum.
    """
    named = sizes.select("source", F.col("source_size").cast("long").alias("source_size"), F.col("source").isNull().alias("__last"))
    placed = ranked(named, ["__last", "source"], "__rank").drop("__last")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = durable(placed.withColumn("__w", F.get(cycle, (F.col("__rank") % len(weights)).cast("int"))))
    cap = F.col("source_size") * F.lit(float(max_repeat))
    all_size, all_weight = weighed.agg(F.sum(F.col("source_size").cast("double")), F.sum("__w")).first()
    level, full = (all_size or 0.0) / (all_weight or 1.0), -1
    while True:
        filled = cap < F.lit(level) * F.col("__w")
        n, held, free = weighed.agg(F.count_if(filled), F.sum(F.when(filled, cap)), F.sum(F.when(~filled, F.col("__w")))).first()
        if n == full or not free:
            break
        level, full = (all_size - (held or 0.0)) / free, n
    return weighed.select("source", "source_size", F.least(cap, F.lit(level) * F.col("__w")).alias("target"))


def thresholds(sized: DataFrame, goals: DataFrame, small: bool) -> DataFrame:
    """(source, __hash, __size) and (source, source_size, target) -> goals with copies (whole
    takes of each row) and below (rows of a smaller hash are taken once more)."""
    hint = F.broadcast if small else (lambda x: x)
    whole = F.floor(F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0)))
    state = durable(goals.withColumn("copies", whole.cast("long")).withColumn("__rest", F.col("target") - F.col("copies") * F.col("source_size")).withColumn("__prefix", F.lit(0).cast("long")).withColumn("__done", F.when(F.col("__rest") <= 0, F.lit(0).cast("long"))))
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        bucket = F.shiftright("__hash", shift)
        inside = hint(state.where("__done is null").select(F.col("source").alias("__s"), "__prefix", "__rest"))
        met = sized.join(inside, F.col("source").eqNullSafe(F.col("__s")) & (F.shiftright("__hash", shift + LEVEL_BITS) == F.col("__prefix")))
        sums = met.groupBy("__s", bucket.alias("__bucket"), "__rest").agg(F.sum("__size").alias("__sum"))
        upto = Window.partitionBy("__s").orderBy("__bucket")
        run = sums.withColumn("__upto", F.sum("__sum").over(upto)).where("__upto > __rest")
        edge = run.groupBy("__s").agg(F.min(F.struct("__bucket", (F.col("__rest") - F.col("__upto") + F.col("__sum")).alias("rest"), F.col("__sum").alias("sum"))).alias("__edge"))
        joined = state.join(hint(edge), F.col("source").eqNullSafe(F.col("__s")), "left")
        bucket_at, rest = F.col("__edge.__bucket"), F.col("__edge.rest")
        top = F.shiftleft(F.col("__prefix") + 1, shift + LEVEL_BITS)  # the budget covers all that is left
        done = F.when(F.col("__edge").isNull(), top)
        if not shift:  # a single hash value: whichever is nearer, with it or without
            done = F.coalesce(done, bucket_at + (F.col("__edge.sum") - rest < rest).cast("long"))
        state = durable(
            joined.select(
                "source", "source_size", "target", "copies",
                F.coalesce(rest, "__rest").alias("__rest"),
                F.coalesce(bucket_at, "__prefix").alias("__prefix"),
                F.coalesce("__done", done).alias("__done"),
            )
        )
    return state.select("source", "source_size", "target", "copies", F.col("__done").alias("below"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeat: float = 3.0, text: str = "text", source: str = "source", id: str = "doc_id") -> DataFrame:
    """One row for each row of ``docs``: doc_id, size (words), source, source_size, target (its
    source's), copies (times the mix takes the whole row) and taken (words taken, with repeats).

    Null texts have size 0 and are taken 0 words; null sources form one source, the last; rows
    with one id share a hash and so go in or out together; an empty table gives no rows. Other
    columns of ``docs`` are ignored, whatever their names.
    """
    sized = durable(docs.select(F.col(id).alias("doc_id"), F.col(source).alias("source"), words(F.col(text)).alias("__size"), hash60(F.col(id)).alias("__hash")))
    sizes = durable(sized.groupBy("source").agg(F.sum("__size").alias("source_size")))
    n, named = sizes.agg(F.count("*"), F.sum(F.length("source"))).first()
    small = n <= BROADCAST_SOURCES and (named or 0) < 16_000_000
    cuts = thresholds(sized, targets(sizes, weights, max_repeat), small)
    cuts = cuts.withColumnRenamed("source", "__s")
    out = sized.join(F.broadcast(cuts) if small else cuts, F.col("source").eqNullSafe(F.col("__s")))
    copies = F.col("copies") + (F.col("__hash") < F.col("below")).cast("long")
    return out.select("doc_id", F.col("__size").alias("size"), "source", "source_size", "target", copies.alias("copies"), (copies * F.col("__size")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeat: float = 3.0) -> DataFrame:
    """The mixed corpus: rows of ``docs`` with all their columns, each as often as the mix takes it, at most
    ``max_repeat`` times.

    Rows without words (null texts too) weigh nothing: they stay in once if their source's threshold or whole
    copies take them, like any other. Null sources form one source, the last. Rows of one id share a hash
    and go in or out together, so ties and repeated rows give the same on every run. An empty table stays
    empty; other columns ride along, whatever their names.
    """
    sized = durable(docs.select(F.col("source").alias("source"), words(F.col("text")).alias("__size"), hash60(F.col("doc_id")).alias("__hash")))
    sizes = durable(sized.groupBy("source").agg(F.sum("__size").alias("source_size")))
    n, named = sizes.agg(F.count("*"), F.sum(F.length("source"))).first()
    small = n <= BROADCAST_SOURCES and (named or 0) < 16_000_000
    of, copies, below, time = free(docs, "__s", "__copies", "__below", "__time")
    cuts = thresholds(sized, targets(sizes, weights, max_repeat), small).select(F.col("source").alias(of), F.col("copies").alias(copies), F.col("below").alias(below))
    met = docs.join(F.broadcast(cuts) if small else cuts, docs["source"].eqNullSafe(F.col(of)))
    times = (F.col(copies) + (hash60(docs["doc_id"]) < F.col(below)).cast("long")).cast("int")
    return met.withColumn(time, F.explode(F.sequence(F.lit(0), times))).where(F.col(time) < times).select(*[docs[f"`{c}`"] for c in docs.columns])
