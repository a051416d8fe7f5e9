"""Budgets, batches and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.operators.ordinal import kept, ordinal


def prefix_within(rows: DataFrame, size: str, order: list[str], budget: int, ceiling: int, by: list[str] | None = None) -> DataFrame:
    """The first rows whose running sum stays within the budget, at least one, at most ``ceiling``.

    The first ``ceiling`` rows are cut out before anything is summed, which tasks do before the shuffle as well (up to the
    session's limit for that), so a queue brings a few rows and isn't sorted as a whole."""
    w = Window.partitionBy(*(by or [])).orderBy(*order)
    few = rows.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= ceiling)
    run = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return few.withColumn("__run", run).where((F.col("__n") == 1) | (F.col("__run") <= budget)).drop("__run", "__n")


def batches(rows: DataFrame, size: str, order: list[str], budget: int, ceiling: int, by: str, block: int = 512) -> DataFrame:
    """W9 again and again over each queue ``by``: greedy next-fit, as the column batch from 0.

    Where a batch that starts at a row ends depends on the next ``ceiling`` rows only. Queues are cut into blocks of
    ``block`` rows, and a block tells for each of its first rows, were it the start of a batch, at which row of the
    next block a batch starts then, and how many start before. These small maps are composed by doubling, in as
    many joins as the blocks have binary digits, so every block learns where its first batch starts, and numbers
    its rows. So a queue is many tasks. Null sizes are 0, a null queue is a queue; ``order`` is unique in a queue."""
    block = max(block, ceiling)
    placed = ordinal(rows, [by, *order], "__at")
    start = placed.groupBy(by).agg(F.min("__at").alias("__start")).withColumnRenamed(by, "__q")
    placed = kept(placed.join(start, placed[by].eqNullSafe(F.col("__q"))).drop("__q").withColumn("__pos", F.col("__at") - F.col("__start")))
    # sizes of a block and of the rows after it that its batches may reach
    own = F.floor(F.col("__pos") / block).cast("long")
    before = F.when((F.col("__pos") % block < ceiling) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    spread = placed.select(F.col("__start").alias("q"), F.col("__pos").alias("pos"), F.coalesce(F.col(size).cast("double"), F.lit(0.0)).alias("s"), F.explode(before).alias("b"))
    held = spread.groupBy("q", "b").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda x: x["s"]).alias("s"))
    own_rows = F.least(F.size("s"), F.lit(block))

    def end(i: Column) -> Column:
        """The row, counted in the block from 0, after the last of a batch that starts at row i."""
        more = lambda a, x: F.when(a["open"] & ((a["n"] == 0) | (a["used"] + x <= budget)), F.struct((a["used"] + x).alias("used"), (a["n"] + 1).alias("n"), F.lit(True).alias("open"))).otherwise(F.struct(a["used"].alias("used"), a["n"].alias("n"), F.lit(False).alias("open")))
        taken = F.aggregate(F.slice("s", i + 1, ceiling), F.struct(F.lit(0.0).alias("used"), F.lit(0).alias("n"), F.lit(True).alias("open")), more, lambda a: a["n"])
        return i + taken

    ends = held.select("q", "b", F.transform(F.sequence(F.lit(0), own_rows - 1), end).alias("next"))
    # from the last row back: (where the next block is entered, batches that start from this row on)
    first = F.array().cast("array<struct<to:int,n:bigint>>")
    leap = lambda a, i: F.struct((F.get(F.col("next"), i) - block).alias("to"), F.lit(1).cast("long").alias("n"))
    # the list grows from the last row on, so row j of the block is at size - 1 - j
    onward = lambda a, i: F.get(a, F.size("next") - 1 - F.get(F.col("next"), i))
    step = lambda a, i: F.array_append(a, F.when(F.get(F.col("next"), i) >= F.size("next"), leap(a, i)).otherwise(F.struct(onward(a, i)["to"].alias("to"), (onward(a, i)["n"] + 1).alias("n"))))
    back = F.aggregate(F.transform(F.sequence(F.lit(1), F.size("next")), lambda k: F.size("next") - k), first, step)
    blocks = kept(ends.select("q", "b", "next", F.slice(F.reverse(back), 1, ceiling).alias("map")))
    entries = _composed(blocks.select("q", "b", "map"))
    marks = blocks.join(entries, ["q", "b"]).select("q", "b", "next", F.coalesce("to", F.lit(0)).alias("to"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))

    def number(a: Column, x: Column) -> Column:
        starts = x["i"] == a["start"]
        n = F.when(starts, a["n"] + 1).otherwise(a["n"])
        return F.struct(F.when(starts, x["next"]).otherwise(a["start"]).alias("start"), n.alias("n"), F.array_append(a["out"], n - 1).alias("out"))

    pairs = F.transform("next", lambda x, i: F.struct(i.alias("i"), x.alias("next")))
    numbers = F.aggregate(pairs, F.struct(F.col("to").alias("start"), F.col("n").alias("n"), F.array().cast("array<bigint>").alias("out")), number, lambda a: a["out"])
    out = marks.select("q", "b", F.posexplode(numbers).alias("i", "batch")).select(F.col("q").alias("__start"), (F.col("b") * block + F.col("i")).alias("__pos"), "batch")
    return placed.join(out, ["__start", "__pos"]).select(*rows.columns, "batch")


def _composed(maps: DataFrame) -> DataFrame:
    """(q, b, to, n) for all blocks of (q, b, map) but the first: where the block is entered if the queue begins with a
    batch, and how many batches start before. After round k a map leads over up to 2**k blocks."""
    most, width = maps.agg(F.max("b")).first()[0] or 0, 1
    while width <= most:
        earlier = maps.select("q", (F.col("b") + width).alias("b"), F.col("map").alias("before"))
        after = lambda e: F.get(F.col("map"), e["to"])
        both = F.transform("before", lambda e: F.struct(after(e)["to"].alias("to"), (e["n"] + after(e)["n"]).alias("n")))
        maps = kept(maps.join(earlier, ["q", "b"], "left").select("q", "b", F.when(F.col("before").isNull(), F.col("map")).otherwise(both).alias("map")))
        width *= 2
    lead = maps.select("q", (F.col("b") + 1).alias("b"), F.get("map", F.lit(0)).alias("e")).select("q", "b", "e.to", "e.n")
    return maps.select("q", "b").join(lead, ["q", "b"], "left")


def terciles(rows: DataFrame, order: list[str], id: str) -> DataFrame:
    """Thirds by rank, the remainder in the last. The ranks are ordinals of rows dealt out by range, so
    no window holds all rows, or all that share a value."""
    ranked = ordinal(rows, [*order, id], "__rank")
    third = max(1, ranked.count() // 3)
    return ranked.withColumn("tercile", F.least(F.floor(F.col("__rank") / third), F.lit(2)).cast("long")).drop("__rank")


def stratified(rows: DataFrame, stratum: str, id: str, n: int, seed: int, strata: int = 3) -> DataFrame:
    """N // strata rows of each stratum, the last one the rest, by the order of a keyed MD5.

    The largest of these numbers is a literal first, so tasks cut their rows down to it before the shuffle."""
    last = n - (strata - 1) * (n // strata)
    want = F.when(F.col(stratum) == strata - 1, last).otherwise(n // strata)
    draw = F.md5(F.concat_ws(":", F.col(id).cast("string"), F.lit(str(seed))))
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(draw, id))
    return rows.withColumn("__rank", rank).where(F.col("__rank") <= max(last, n // strata)).where(F.col("__rank") <= want).drop("__rank")


def estimated_tokens(text: Column, for_packing: bool = False) -> Column:
    """N19."""
    return F.floor(F.length(text) / 3) + 600 if for_packing else F.floor(F.length(text) / 4)
