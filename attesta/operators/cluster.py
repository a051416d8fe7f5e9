"""Merging the scales of several coders of one paper, and pairing those of two.

Both are greedy in the order of the scales, yet run over all papers at once: similar scales are found by a
join on few of their words, and then all those settle together that no earlier one can still change.
Papers are no groups of rows here, so one that holds a third of all scales is many tasks."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.operators import overlaps
from attesta.operators.ordinal import kept, ordinal

SIMILAR = 0.6
#: Undecided rows up to which one task settles the rest, one after another.
FEW = 50_000
#: Words of the sets of one paper, or of several small ones, that meet in one task.
MOST = 500_000


def similar_pairs(a: DataFrame, b: DataFrame | None = None, similar: float = SIMILAR, most: int = MOST) -> DataFrame:
    """(by, a, b, similarity) for sets of words (by, id, tokens) of one ``by`` that share at least ``similar``
    of the smaller one. Repeated words count once, empty sets pair with none. Without ``b``, pairs of a's own in both
    directions, none of a set with itself.

    Sets of one ``by`` meet as a whole in one task, which looks for pairs by the sets' rarest words, so that candidates are never shuffled. Small ``by``
    share a task; one of more than ``most`` words (as counted, or as a column n has them) is dealt into blocks by digests of ids, and each two blocks are a
    task's, so a set goes to as many tasks as there are blocks."""
    spark = a.sparkSession
    frames = [a] if b is None else [a, b]
    words = F.array_distinct(F.filter("tokens", lambda w: w.isNotNull()))
    sets = [x.where("by is not null").select("by", "id", words.alias("tokens")).where(F.size("tokens") > 0) for x in frames]
    counted = [x.select("by", "n") if "n" in x.columns else y.select("by", F.size("tokens").alias("n")) for x, y in zip(frames, sets, strict=True)]
    sizes = kept((counted[0] if b is None else counted[0].unionByName(counted[1])).groupBy("by").agg(F.sum("n").alias("n")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = max(2 * parts, (sizes.agg(F.sum("n")).first()[0] or 0) // most)
    large = F.broadcast(sizes.where(F.col("n") > most).select("by", F.ceil(F.col("n") / most).cast("int").alias("blocks")))  # few: each has so many words
    block, other = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = [x.join(large, "by", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumns({"block": block, "other": other}) for x in sets]
    alone = [F.when(F.col("blocks") > 1, F.col("by")).alias("of"), F.when(F.col("blocks") > 1, 0).otherwise(F.pmod(F.xxhash64("by"), F.lit(spread))).cast("long").alias("spread")]
    if b is None:
        i, j = F.least("block", "other"), F.greatest("block", "other")
        rows = dealt[0].select(*alone, i.alias("i"), j.alias("j"), (F.col("block") > F.col("other")).alias("side"), "by", F.col("id").alias("a"), F.col("id").alias("b"), "tokens")
    else:
        kinds = [x.schema["id"].dataType for x in frames]
        id = lambda n, side: (F.col("id") if n == side else F.lit(None).cast(kinds[n])).alias("ab"[n])
        spots = [("block", "other"), ("other", "block")]
        one, two = (x.select(*alone, F.col(i).alias("i"), F.col(j).alias("j"), F.lit(k == 1).alias("side"), "by", id(0, k), id(1, k), "tokens") for k, (x, (i, j)) in enumerate(zip(dealt, spots, strict=True)))
        rows = one.unionByName(two)
    own = b is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches))
        within = own and held["i"][0] == held["j"][0]
        ids = held.select(["by", "a", "b"]).combine_chunks()
        side = held["side"].to_numpy()
        for x, y, share in overlaps.Sets(held, similar).pairs(None if within else side):
            if own:
                x, y, share = np.append(x, y), np.append(y, x), np.append(share, share)
            else:
                x, y = np.where(side[x], y, x), np.where(side[x], x, y)
            columns = [ids["by"].take(x), ids["a"].take(x), ids["b"].take(y)]
            yield from pa.table([*columns, pa.array(share)], ["by", "a", "b", "similarity"]).to_batches()

    kinds = [rows.schema[c].simpleString().partition(":")[2] for c in ("by", "a", "b")]
    cells = ["of", "spread", "i", "j"]
    return rows.repartition(parts, *cells).groupBy(*cells).applyInArrow(run, f"by {kinds[0]}, a {kinds[1]}, b {kinds[2]}, similarity double")


def clustered(scales: DataFrame, similar: float = SIMILAR, few: int = FEW) -> DataFrame:
    """Scales (paper_id, ord, key, tokens) with the column cluster: a scale joins the first cluster whose
    first scale has its key, unless that is empty, else the first whose first scale's tokens overlap by
    ``similar``, else it founds one. Clusters of a paper are numbered from 0 in the order of their founders.

    Scales of equal key and tokens are one here. In each round a scale founds if no undecided earlier one has its
    key or similar tokens, and decides all that have; at least each paper's first undecided scale does. Equal
    ``ord`` go by digests of key and tokens; a null key or list is empty; scales of no paper are left out."""
    words = F.array_sort(F.array_distinct(F.filter("tokens", lambda w: w.isNotNull())))
    # digests of 128 bits stand for keys and sets of words, which may be long
    tagged = scales.where("paper_id is not null").withColumns({"__k": F.md5(F.nullif("key", F.lit(""))), "__t": F.when(F.size(words) > 0, F.md5(F.to_json(words))), "__n": F.size(words)})
    rows = ordinal(tagged, ["paper_id", "ord", "__k", "__t"], "__at")
    kinds = rows.groupBy("paper_id", "__k", "__t").agg(F.min("__at").alias("at"))
    group = lambda c, name: kinds.where(f"{c} is not null").groupBy("paper_id", c).agg(F.min("at").alias(name))
    keyed = kinds.where("__k is not null or __t is not null").join(group("__k", "kg"), ["paper_id", "__k"], "left").join(group("__t", "tg"), ["paper_id", "__t"], "left")
    keyed = kept(keyed.select("paper_id", "__k", "__t", "at", "kg", "tg"))
    firsts = keyed.where("at = tg").select(F.col("tg").alias("id"))
    sets = rows.select(F.col("paper_id").alias("by"), F.col("__at").alias("id"), "tokens", F.col("__n").alias("n")).join(firsts, "id", "left_semi")
    edges = kept(similar_pairs(sets, similar=similar).select("a", "b"))
    founders = _founders(keyed.select("at", "kg", "tg"), edges, few)

    # the founder of each key, and the first founder near each set of words
    by_key = founders.where("kg is not null").select("kg", F.col("at").alias("of_key"))
    near = edges.join(founders.select(F.col("tg").alias("b"), "at"), "b").select(F.col("a").alias("tg"), "at").unionByName(founders.where("tg is not null").select("tg", "at"))
    by_words = near.groupBy("tg").agg(F.min("at").alias("of_words"))
    spots = keyed.select("paper_id", "__k", "__t", "kg", "tg").join(by_key, "kg", "left").join(by_words, "tg", "left").select("paper_id", "__k", "__t", "of_key", "of_words")
    alike = lambda c: F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}"))
    # keys and words stay behind until each scale has its cluster
    met = rows.select("paper_id", "__k", "__t", "__at").alias("r").join(spots.alias("s"), (F.col("r.paper_id") == F.col("s.paper_id")) & alike("__k") & alike("__t"), "left")
    # a founder of the key that comes later than the scale wasn't there yet
    at = F.col("r.__at")
    head = F.coalesce(F.when(F.col("s.of_key") <= at, F.col("s.of_key")), F.col("s.of_words"), at)
    placed = kept(met.select("r.paper_id", "r.__at", head.alias("__head")))
    first = placed.where("__head = __at").select("paper_id", "__at")
    numbered = ordinal(first, ["paper_id", "__at"], "__n")
    start = numbered.groupBy("paper_id").agg(F.min("__n").alias("__start"))
    names = numbered.join(start, "paper_id").select(F.col("__at").alias("__head"), (F.col("__n") - F.col("__start")).alias("cluster"))
    return rows.join(placed.join(names, "__head").select("__at", "cluster"), "__at").select(*scales.columns, "cluster")


def _founders(open: DataFrame, edges: DataFrame, few: int) -> DataFrame:
    """(at, kg, tg) of those of (at, kg, tg) that found: in the order of ``at``, each that no earlier founder
    excludes, by an equal kg, an equal tg, or an edge between their tg. ``edges`` holds both directions."""
    found = None
    while True:
        left = open.count()
        if not left:
            return found if found is not None else open
        if left + edges.count() <= few:
            last = _last(open, edges)
            return last if found is None else found.unionByName(last)
        own = open.where("tg is not null").groupBy("tg").agg(F.min(F.struct("at", "kg")).alias("m")).select("tg", "m.at", "m.kg")
        key = open.where("kg is not null").groupBy("kg").agg(F.min(F.struct("at", "tg")).alias("m")).select("kg", "m.at", "m.tg")
        around = edges.join(own.select(F.col("tg").alias("b"), "at"), "b").groupBy(F.col("a").alias("tg")).agg(F.min("at").alias("near"))
        first = own.join(around, "tg", "left").where("near is null or at < near").drop("near")
        with_key = first.where("kg is not null").join(key.select("kg", "at"), ["kg", "at"])
        now = with_key.select("at", "kg", "tg").unionByName(first.where("kg is null").select("at", "kg", "tg")).unionByName(key.where("tg is null").select("at", "kg", "tg"))
        now = kept(now)
        gone = kept(now.where("tg is not null").select("tg").unionByName(edges.join(now.select(F.col("tg").alias("a")), "a").select(F.col("b").alias("tg"))).distinct())
        open = kept(open.join(gone, "tg", "left_anti").join(now.where("kg is not null").select("kg"), "kg", "left_anti"))
        held = open.where("tg is not null").select("tg").distinct()
        edges = kept(edges.join(held.withColumnRenamed("tg", "a"), "a", "left_semi").join(held.withColumnRenamed("tg", "b"), "b", "left_semi"))
        found = now if found is None else found.unionByName(now)


def _last(open: DataFrame, edges: DataFrame) -> DataFrame:
    """What ``_founders`` does, for few rows, in one task."""
    both = open.select("at", "kg", "tg", F.lit(None).cast("long").alias("to")).unionByName(edges.select(F.lit(None).cast("long").alias("at"), F.lit(None).cast("long").alias("kg"), F.col("a").alias("tg"), F.col("b").alias("to")))

    def run(frames):
        near, rows = defaultdict(list), []
        for f in frames:
            for at, kg, tg, to in f.astype(object).where(f.notna(), None).itertuples(index=False, name=None):
                if at is None:
                    near[tg].append(to)
                else:
                    rows.append((int(at), kg, tg))
        keys, sets, out = set(), set(), []
        for at, kg, tg in sorted(rows, key=lambda r: r[0]):
            if kg in keys or tg in sets:
                continue
            out.append((at, kg, tg))
            if kg is not None:
                keys.add(kg)
            if tg is not None:
                sets.update([tg, *near[tg]])
        yield pd.DataFrame(out, columns=["at", "kg", "tg"]).astype("Int64")

    return kept(both.coalesce(1).mapInPandas(run, "at long, kg long, tg long"))


def merged(items: DataFrame, scales: DataFrame) -> DataFrame:
    """Clustered scales (paper_id, cluster, ord, key, tokens, subscales, attested) with verified items
    (paper_id, ord, item, key) -> one row per cluster: the name key of its richest scale, all subscales
    once, whether any is attested, and items, each key once, the first scale's copy. Repeats are aggregated before
    any list is made, so a list is no longer than what comes out."""
    by = ["paper_id", "cluster"]
    heads = scales.groupBy(*by).agg(F.min_by("key", F.struct(-F.coalesce(F.size("tokens"), F.lit(0)), F.col("ord"))).alias("base"), F.max("attested").alias("attested"))
    parts = scales.select(*by, "ord", F.posexplode(F.transform(F.split("subscales", ";"), lambda p: F.trim(p))).alias("at", "part")).where("part <> ''")
    first = parts.groupBy(*by, F.lower("part").alias("__p")).agg(F.min(F.struct("ord", "at", "part")).alias("s"))
    subscales = first.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["part"]), "; ").alias("subscales"))
    placed = items.join(scales.select("paper_id", "ord", "cluster"), ["paper_id", "ord"])
    copies = placed.groupBy(*by, "key").agg(F.min(F.struct("ord", "item")).alias("s"))
    lists = copies.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("s.ord", "s.item", "key"))), lambda x: x["key"]).alias("items"))
    out = heads.join(subscales, by, "left").join(lists, by, "left")
    return out.select(*by, "base", F.coalesce("subscales", F.lit("")).alias("subscales"), "attested", "items")


def fuzzy_pairs(a: DataFrame, b: DataFrame, by: str, similar: float = SIMILAR) -> DataFrame:
    """The most similar of B's scales (by, id, key, tokens) for each of A: of equal key, else of overlap from
    ``similar``, ties to the least id; also one that another has taken. ``matched`` is one-to-one."""
    one, two = (x.select(by, "key", F.col("id").alias(c)) for x, c in ((a, "id_a"), (b, "id_b")))
    # of each key the least partner; what has one needs no search among words
    least = two.groupBy(by, "key").agg(F.min("id_b").alias("id_b"))
    exact = one.join(least, [by, "key"]).select(by, "id_a", "id_b", F.lit(1.0).alias("similarity"), F.lit(0).alias("kind"))
    words = F.array_sort(F.array_distinct(F.filter("tokens", lambda w: w.isNotNull())))
    sets = lambda x: x.select(F.col(by).alias("by"), "id", words.alias("tokens")).where(F.size("tokens") > 0)
    # scales of equal words are one: those of A share their best partner, and of B's the least is it
    loose = kept(sets(a.join(two.select(by, "key"), [by, "key"], "left_anti")).withColumn("__t", F.md5(F.to_json("tokens"))))
    asked = kept(loose.groupBy("by", "__t").agg(F.first("tokens").alias("tokens")).withColumn("id", F.monotonically_increasing_id()))
    held = kept(sets(b).groupBy("by", "tokens").agg(F.min("id").alias("id")))
    near = similar_pairs(asked.select("by", "id", "tokens"), held.select("by", "id", "tokens"), similar)
    best = near.groupBy("by", "a").agg(F.min(F.struct(-F.col("similarity"), F.col("b").alias("id_b"), "similarity")).alias("m"))
    first = asked.select("by", "__t", F.col("id").alias("a")).join(best, ["by", "a"]).select("by", "__t", "m.id_b", "m.similarity")
    found = loose.join(first, ["by", "__t"]).select(F.col("by").alias(by), F.col("id").alias("id_a"), "id_b", "similarity", F.lit(1).alias("kind"))
    chosen = exact.unionByName(found).groupBy(by, "id_a").agg(F.min(F.struct("kind", -F.col("similarity"), "id_b", "similarity")).alias("m"))
    return chosen.select(by, "id_a", "m.id_b", "m.similarity")


def matched(a: DataFrame, b: DataFrame, by: str, similar: float = SIMILAR, few: int = FEW, digits: int | None = None) -> DataFrame:
    """One-to-one pairs of the coders' scales (by, ord, key, tokens) with both leftovers: rows (by, kind, ord_a,
    ord_b), kind pair, only_a or only_b. In their order, each scale of A takes that of B of its key, or where B has
    none of its key, the most similar unused one from ``similar`` on, the first of equals. Scales of B of one key are used
    together; a pair by key names the last of these, one by words the first. A scale whose partner is used stays alone.
    With ``digits``, similarities that are equal when rounded to so many count as equal.

    In each round those scales of A settle whose best unused partner no undecided earlier one could take; at least
    the first undecided one of each group does. Nulls in key are empty; ``ord`` is unique within a group and side."""
    named = lambda x: x.select(F.col(by).alias("by"), "ord", F.md5(F.coalesce("key", F.lit(""))).alias("key"), "tokens")
    rows = ordinal(named(a), ["by", "ord"], "at")
    sides = ordinal(named(b), ["by", "ord"], "pos")
    keys = kept(sides.groupBy("by", "key").agg(F.min("pos").alias("first"), F.max("pos").alias("last")))
    exact = rows.join(keys, ["by", "key"]).select("at", F.lit(0).alias("kind"), F.lit(-1.0).alias("less"), F.col("first").alias("spot"), F.col("first").alias("used"), F.col("last").alias("to"))
    loose = rows.join(keys.select("by", "key"), ["by", "key"], "left_anti").select("by", F.col("at").alias("id"), "tokens")
    spots = sides.join(keys.select("by", "key", "first"), ["by", "key"]).select("by", F.col("pos").alias("id"), "tokens", F.col("first"))
    near = similar_pairs(loose, spots.select("by", "id", "tokens"), similar).join(spots.select(F.col("id").alias("b"), "first"), "b")
    alike = F.col("similarity") if digits is None else F.round("similarity", digits)
    edges = exact.unionByName(near.select(F.col("a").alias("at"), F.lit(1).alias("kind"), (-alike).alias("less"), F.col("b").alias("spot"), F.col("first").alias("used"), F.col("b").alias("to")))
    pairs = _settled(kept(edges), few)
    done = pairs.join(rows.select("at", "by", F.col("ord").alias("ord_a")), "at").join(sides.select(F.col("pos").alias("to"), F.col("ord").alias("ord_b")), "to")
    alone = rows.join(pairs.select("at"), "at", "left_anti").select("by", F.lit("only_a").alias("kind"), F.col("ord").alias("ord_a"), F.lit(None).cast(dict(b.dtypes)["ord"]).alias("ord_b"))
    over = keys.join(pairs.select(F.col("used").alias("first")), "first", "left_anti").select("by", "key")
    left = sides.join(over, ["by", "key"]).select("by", F.lit("only_b").alias("kind"), F.lit(None).cast(dict(a.dtypes)["ord"]).alias("ord_a"), F.col("ord").alias("ord_b"))
    return done.select("by", F.lit("pair").alias("kind"), "ord_a", "ord_b").unionByName(alone).unionByName(left).withColumnRenamed("by", by)


def _settled(edges: DataFrame, few: int) -> DataFrame:
    """(at, used, to): in the order of ``at``, the best of its edges (at, less, spot, used, to) whose ``used`` is free."""
    found = None
    while n := edges.count():
        if n <= few:
            last = _rest(edges)
            return last if found is None else found.unionByName(last)
        best = edges.groupBy("at").agg(F.min(F.struct("less", "spot", "used", "to")).alias("m")).select("at", "m.used", "m.to")
        first = edges.groupBy("used").agg(F.min("at").alias("at"))
        now = kept(best.join(first, ["used", "at"]).select("at", "used", "to"))
        edges = kept(edges.join(now.select("at"), "at", "left_anti").join(now.select("used"), "used", "left_anti"))
        found = now if found is None else found.unionByName(now)
    return found if found is not None else edges.select("at", "used", "to")


def _rest(edges: DataFrame) -> DataFrame:
    def run(frames):
        rows = sorted(r for f in frames for r in f[["at", "less", "spot", "used", "to"]].itertuples(index=False, name=None))
        taken, used, out = set(), set(), []
        for at, _, _, u, to in rows:
            if at not in taken and u not in used:
                out.append((at, u, to))
                taken.add(at), used.add(u)
        yield pd.DataFrame(out, columns=["at", "used", "to"], dtype="int64")

    return kept(edges.coalesce(1).mapInPandas(run, "at long, used long, to long"))
