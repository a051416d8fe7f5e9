"""Keeping only what the source document prints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators import runs
from attesta.sources.scratch import folder

#: Halves of needles, and needles of two frequent halves, that may be broadcast: some tens of bytes each.
FEW = 100_000
#: Words' places in texts up to which a half of a needle is rare, whatever their number.
MANY = 1_000


def printed(key: Column, source: Column) -> Column:
    """P10: a key that isn't empty and that the normalised source contains."""
    return (key != "") & F.contains(source, key)


def attested(source: Column, *names: Column) -> Column:
    """Any of the normalised names, of three characters and more, stands in the source."""
    keys = F.array(*[T.evidence_norm(n) for n in names])
    return F.exists(keys, lambda k: (F.length(k) >= 3) & F.contains(source, k))


def verified_items(items: DataFrame, sources: DataFrame, paper: str, key: str, ordinal: str, within: list[str] | None = None) -> DataFrame:
    """Items whose key stands in their own paper's source, each key once per paper (and
    ``within``), the first by ``ordinal``. sources: (paper, source_norm)."""
    met = items.join(sources, paper).where(printed(F.col(key), F.col("source_norm"))).drop("source_norm")
    groups = [paper, *(within or []), key]
    first = F.row_number().over(Window.partitionBy(*groups).orderBy(ordinal))
    return met.withColumn("__first", first).where("__first = 1").drop("__first")


def evidence_pairs(needles: DataFrame, needle: str, sources: DataFrame, source: str, most_bytes: int = 200_000, gram: int = 4, carry: list[str] | None = None) -> DataFrame:
    """Cross-document containment: (needle row, source row) where the source contains the needle. With ``carry``, only
    these columns of the sources come out; texts that are not among them are read once and never shuffled.

    Needles of up to ``most_bytes`` in all (measured first) are broadcast. Of larger sets only a table of bits is, of
    at most ``MOST_BITS``: the hashes of the needles and of their first ``gram`` bytes, doubled as often as they have as many. A task that
    reads a text takes from it, each once, the runs of bytes that the table lets through, and these meet the needles by
    equality. So the table may let too much through, but never decides; what is shuffled is no more than pairs that
    come out and such strays."""
    held = _saved(needles.where(F.col(needle) != ""))
    carry = sources.columns if carry is None else carry
    sizes = dict(held.groupBy(F.octet_length(needle)).count().collect())  # one number for each length
    if sum(n * c for n, c in sizes.items()) <= most_bytes:
        return sources.join(F.broadcast(held), F.contains(F.col(source), F.col(needle))).select(*carry, *held.columns)
    lengths = sorted(sizes)
    table = runs.table(held, needle, sum(sizes.values()), lengths, gram)
    texts = sources.select(*carry, source) if source not in carry else _saved(sources.withColumn("__h", F.monotonically_increasing_id()))
    found = runs.found(texts if source not in carry else texts.select("__h", source), source, "__key", lengths, gram, table)
    # a hash of the needles spares sorting what was found
    met = found.join(held.hint("shuffle_hash"), F.col("__key") == F.col(needle))
    return (met.join(texts, "__h") if source in carry else met).select(*carry, *held.columns)


def _saved(df: DataFrame) -> DataFrame:
    """``df`` computed once, in a folder of its own."""
    at = folder(df.sparkSession)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def _by_halves(two: DataFrame, known: DataFrame, texts: DataFrame, source: str) -> tuple[DataFrame, DataFrame | None]:
    """For needles (__n, head, tail) of two words: (__word, __n, __sure) of the words that have the rarer half, and
    (__h, __n, __sure) of the texts where words of two frequent halves are neighbours. ``evidence_pairs`` did this before it
    searched by runs; it finds up to a fiftieth of the texts for each needle, so its work grows with the square."""
    halves = two.select(F.explode(F.array(F.struct(F.lit("end").alias("kind"), F.col("head").alias("key")), F.struct(F.lit("begin").alias("kind"), F.col("tail").alias("key")))).alias("x")).select("x.*").distinct()
    longest = halves.agg(F.max(F.length("key"))).first()[0] or 0
    sizes = F.sequence(F.lit(1), F.least(F.length("__word"), F.lit(max(longest, 1))))
    cut = F.concat(F.transform(sizes, lambda i: F.struct(F.lit("end").alias("kind"), F.right(F.col("__word"), i).alias("key"))), F.transform(sizes, lambda i: F.struct(F.lit("begin").alias("kind"), F.left(F.col("__word"), i).alias("key"))))
    edges = known.select("__word", "c", F.explode(cut).alias("x")).select("__word", "c", "x.kind", "x.key")
    count = edges.join(F.broadcast(halves) if halves.count() <= FEW else halves, ["kind", "key"]).groupBy("kind", "key").agg(F.sum("c").alias("c"))
    of = lambda kind, key: count.where(F.col("kind") == kind).select(F.col("key").alias(key), F.col("c").alias(f"of_{key}"))
    # a half that no word has means no text
    chosen = _saved(two.join(of("end", "head"), "head").join(of("begin", "tail"), "tail").withColumn("least", F.least("of_head", "of_tail")))
    many = max(MANY, texts.count() // 50)
    often = chosen.where(F.col("least") > many)
    apart = 0 < often.count() <= FEW
    rare = (chosen.where(F.col("least") <= many) if apart else chosen).select("__n", F.when(F.col("of_head") <= F.col("of_tail"), "end").otherwise("begin").alias("kind"), F.when(F.col("of_head") <= F.col("of_tail"), F.col("head")).otherwise(F.col("tail")).alias("key"))
    ends = edges.join(F.broadcast(rare) if rare.count() <= FEW else rare, ["kind", "key"]).select("__word", "__n", F.lit(False).alias("__sure"))
    return ends, _neighbours(texts, source, [tuple(r) for r in often.select("__n", "head", "tail").collect()]) if apart else None


def _neighbours(texts: DataFrame, source: str, needles: list[tuple[int, str, str]]) -> DataFrame:
    """(__h, __n, __sure) of the texts with a word that ends in the head of a needle (__n, head, tail), and then one that begins
    with its tail."""

    def run(frames):
        import re

        import pandas as pd

        after, starts, known, space = {}, {t for _, _, t in needles}, ({}, {}), re.compile("[ \t\n\x0b\x0c\r]+")
        for n, x, y in needles:
            after.setdefault(x, {}).setdefault(y, []).append(n)
        long = [max(map(len, x), default=0) for x in (after, starts)]
        for f in frames:
            rows = []
            for h, text in zip(f["__h"], f[source], strict=True):
                if sum(map(len, known)) > 500_000:
                    known = ({}, {})
                words, found = space.split(text or ""), set()
                for u, v in zip(words[:-1], words[1:], strict=True):
                    if (x := known[0].get(u)) is None:
                        x = known[0][u] = [after[e] for i in range(1, min(len(u), long[0]) + 1) if (e := u[-i:]) in after]
                    if not x:
                        continue
                    if (y := known[1].get(v)) is None:
                        y = known[1][v] = [e for i in range(1, min(len(v), long[1]) + 1) if (e := v[:i]) in starts]
                    for a in x:
                        for e in y:
                            if e in a:
                                found.update(a[e])
                rows += [(h, n, False) for n in found]
            yield pd.DataFrame(rows, columns=["__h", "__n", "__sure"])

    return texts.select("__h", source).mapInPandas(run, "__h long, __n long, __sure boolean")


def verified_keys(tagged: DataFrame, sources: DataFrame, paper: str, key: str) -> DataFrame:
    """The coders' verified key sets: rows (paper, key, in_a, in_b), of both coders, each key once per paper,
    where the paper's source contains it. Sources are normalised and joined once for both."""
    keys = tagged.groupBy(paper, key).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    return keys.join(sources, paper).where(printed(F.col(key), F.col("source_norm"))).drop("source_norm")


def coder_overlap(verified: DataFrame, paper: str) -> DataFrame:
    """For each paper the sizes of both verified key sets, of what they share and of all,
    and the Jaccard index (null if both are empty)."""
    a, b = F.col("in_a").cast("long"), F.col("in_b").cast("long")
    sums = verified.groupBy(paper).agg(F.sum(a).alias("n_a"), F.sum(b).alias("n_b"), F.sum(a * b).alias("n_both"), F.count("*").alias("n_all"))
    return sums.withColumn("jaccard", F.try_divide(F.col("n_both").cast("double"), F.col("n_all")))


def pooled(overlap: DataFrame) -> DataFrame:
    """Overlap and recall over the whole corpus, and A11's mean and share at 0.9 and more."""
    n = lambda c: F.sum(c).cast("double")
    return overlap.agg(
        F.try_divide(n("n_both"), F.sum("n_all")).alias("overlap"),
        F.try_divide(n("n_a"), F.sum("n_all")).alias("recall_a"),
        F.try_divide(n("n_b"), F.sum("n_all")).alias("recall_b"),
        F.avg("jaccard").alias("mean_jaccard"),
        F.avg((F.col("jaccard") >= 0.9).cast("double")).alias("share_at_90"),
    )
