"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions only.

Two lines are near when at most one word differs: replaced, left out or put in. A line's
neighbourhood is the line itself and, for each of its words, the line without it; each variant is
emitted as a hashed key. Near lines share a key. Each line is compared with the earliest line of each
of its keys, and the edit distance is verified on the words. Where a pair is refused (the word stood
at another place), the lines of the key meet again by key and place, which only near lines share. So no
key makes pairs of all its lines.

A variant's hash is a sum over adjacent words, so taking a word out is two terms less and one more,
whatever the length of the line.

Only lines that could have a neighbour get variants: lines within one word of each other agree in
their first or in their last words (as many as half the shorter line, down to a power of two), and one
sum over these ends tells which lines stand alone. Equal lines are one class from the start. Texts
are shuffled twice, to fetch such lines and to cut the result; all else is hashes and numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.runtime import free, ranked, written

#: Lines of fewer words are neither removed nor make others be removed.
MIN_WORDS = 6
_OTHER_SPACE = r"[\x09-\x0D]"


def _words(line: Column) -> Column:
    plain = F.when(line.rlike(_OTHER_SPACE), F.regexp_replace(line, _OTHER_SPACE, " ")).otherwise(line)
    return F.array_remove(F.split(plain, " "), "")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _ends(words: Column, n: Column) -> Column:
    """Keys of the first and last words, for the lengths that this line and one a word shorter or
    longer use."""

    def half(n: Column) -> Column:
        return F.pow(F.lit(2.0), F.length(F.bin(F.shiftright(F.greatest(n - 1, F.lit(2)), 1))) - 1).cast("int")

    lengths = F.array_distinct(F.array(half(n - 1), half(n), half(n + 1)))
    first = F.transform(lengths, lambda p: F.xxhash64(F.lit("first"), p, F.slice(words, F.lit(1), p)))
    last = F.transform(lengths, lambda p: F.xxhash64(F.lit("last"), p, F.slice(words, -p, p)))
    return F.concat(first, last)


def _pair(words: Column, i: Column, j: Column) -> Column:
    """Hash of words i and j as neighbours; 48 bits, so that sums stay within a long."""
    at = lambda k: F.coalesce(F.get(words, k), F.lit(""))
    return F.shiftrightunsigned(F.xxhash64(at(i), at(j)), 16)


def _whole(words: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(0), F.size(words)), F.lit(0).cast("long"), lambda total, i: total + _pair(words, i - 1, i))


def _variants(words: Column, whole: Column) -> Column:
    """Keys of the line itself and of the line without each of its words."""
    n = F.size(words)
    without = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.xxhash64(whole - _pair(words, i - 1, i) - _pair(words, i, i + 1) + _pair(words, i - 1, i + 1), n - 1),
    )
    return F.array_distinct(F.concat(F.array(F.xxhash64(whole, n)), without))


def _near(a: Column, b: Column) -> Column:
    """At most one word put in, left out or replaced: what agrees from the front and from the back
    covers all but one word of the longer."""

    def agreed(x: Column, y: Column) -> Column:
        same = F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)))
        at = F.array_position(same, False)
        return F.when(at == 0, F.size(same).cast("long")).otherwise(at - 1)

    return agreed(a, b) + agreed(F.reverse(a), F.reverse(b)) >= F.greatest(F.size(a), F.size(b)) - 1


def _placed(words: Column, whole: Column) -> Column:
    """Keys of the variants with the place of the word: lines that share one are near."""
    n = F.size(words)
    without = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.xxhash64(whole - _pair(words, i - 1, i) - _pair(words, i, i + 1) + _pair(words, i - 1, i + 1), n - 1, i),
    )
    return F.concat(without, F.transform(F.sequence(F.lit(0), n), lambda i: F.xxhash64(whole, n, i)))


def _verified(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """(ord, head) with ok: whether the edit distance of their words is within the bound."""
    a, b = near.select("ord", F.col("words").alias("w")), near.select(F.col("ord").alias("head"), F.col("words").alias("v"))
    return pairs.join(a, "ord").join(b, "head").select("ord", "head", _near(F.col("w"), F.col("v")).alias("ok"))


def _occurrences(rows: DataFrame, min_words: int) -> DataFrame:
    lines = rows.select("doc", "row", F.posexplode(_lines(F.col("text"))).alias("no", "line"))
    lines = lines.where(F.octet_length("line") >= 2 * min_words - 1)  # shorter lines have too few words
    split = lines.select("doc", "row", "no", F.xxhash64("line").alias("c1"), F.xxhash64("line", F.lit(1)).alias("c2"), _words(F.col("line")).alias("words"))
    n = F.size("words")
    return split.where(n >= min_words).select("doc", "row", "no", "c1", "c2", _ends(F.col("words"), n).alias("ends"))


def _earlier(rows: DataFrame, classes: DataFrame, seen: DataFrame) -> DataFrame:
    """(c1, c2, doc, no): for lines with a near line before their own first place, its place."""
    c1 = F.col("c1")
    shared = seen.select(F.explode("ends").alias("end"), "c1").groupBy("end").agg(F.min(c1).alias("lo"), F.max(c1).alias("hi")).where("lo <> hi").select("end")
    could = classes.select(F.explode("ends").alias("end"), "c1", "c2", "doc", "no").join(shared, "end").select("c1", "c2", "doc", "no").distinct()
    could = ranked(could, ["doc", "no", "c1", "c2"], "ord")
    wanted = could.groupBy("doc").agg(F.collect_list(F.struct("no", "ord", "c1")).alias("want")).withColumnRenamed("doc", "own")
    lines = rows.join(wanted, F.col("doc").eqNullSafe(F.col("own"))).select(_lines(F.col("text")).alias("lines"), "want")
    lines = lines.select(F.explode(F.transform("want", lambda w: F.struct(w["ord"].alias("ord"), w["c1"].alias("c1"), F.get("lines", w["no"]).alias("line")))).alias("x"))
    lines = lines.where(F.xxhash64("x.line") == F.col("x.c1")).select("x.ord", _words(F.col("x.line")).alias("words"))
    near = written(lines.withColumn("whole", _whole(F.col("words"))))
    keyed = written(near.select("ord", F.explode(_variants(F.col("words"), F.col("whole"))).alias("key")))
    heads = keyed.groupBy("key").agg(F.min("ord").alias("head"), F.max("ord").alias("tail")).where("head <> tail").select("key", "head")
    pairs = written(keyed.join(heads, "key").where("ord <> head").select("ord", "head", "key"))
    checked = written(_verified(pairs.select("ord", "head").distinct(), near))
    found = checked.where("ok").select("ord", "head")
    refused = checked.where("not ok").select("ord", "head")
    if refused.limit(1).count():
        # their words stood at other places: lines of such keys meet by place as well
        keys = pairs.join(refused, ["ord", "head"]).select("key").distinct()
        again = near.join(keyed.join(keys, "key").select("ord").distinct(), "ord", "left_semi")
        placed = written(again.select("ord", F.explode(_placed(F.col("words"), F.col("whole"))).alias("key")))
        heads = placed.groupBy("key").agg(F.min("ord").alias("head"), F.max("ord").alias("tail")).where("head <> tail").select("key", "head")
        more = placed.join(heads, "key").where("ord <> head").select("ord", "head").distinct()
        found = found.unionByName(_verified(more, near).where("ok").select("ord", "head"))
    best = found.groupBy("ord").agg(F.min("head").alias("head"))
    place = could.select(F.col("ord").alias("head"), "doc", "no")
    return best.join(could.select("ord", "c1", "c2"), "ord").join(place, "head").select("c1", "c2", "doc", "no")


def removals(docs: DataFrame, min_words: int = MIN_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, row, gone): numbers of the lines that go, for each document that loses any; row is a
    hash of its text."""
    rows = docs.select(F.col(id).alias("doc"), F.xxhash64(F.col(text)).alias("row"), F.col(text).alias("text"))
    seen = written(_occurrences(rows, min_words))
    spot = F.struct("doc", "no")
    classes = written(seen.groupBy("c1", "c2").agg(F.min(spot).alias("own"), F.first("ends").alias("ends")).select("c1", "c2", "own.doc", "own.no", "ends"))
    better = _earlier(rows, classes, seen)
    first = classes.select("c1", "c2", spot.alias("own")).join(better.select("c1", "c2", spot.alias("at")), ["c1", "c2"], "left")
    first = written(first.select("c1", "c2", F.least("own", "at").alias("first")))
    gone = seen.select("doc", "row", "no", "c1", "c2").join(first, ["c1", "c2"]).where(F.col("first") < spot)
    return gone.groupBy("doc", "row").agg(F.collect_set("no").alias("gone"))


def _cut(docs: DataFrame, min_words: int, id: str, text: str) -> tuple[DataFrame, Column, Column]:
    doc, row, lost = free(docs, "__doc", "__row", "__gone")
    gone = removals(docs, min_words, id, text).select(F.col("doc").alias(doc), F.col("row").alias(row), F.col("gone").alias(lost))
    met = docs.join(gone, docs[id].eqNullSafe(F.col(doc)) & (F.xxhash64(docs[text]) == F.col(row)), "left")
    drop = F.coalesce(F.col(lost), F.array().cast("array<int>"))
    left = F.array_join(F.filter(_lines(docs[text]), lambda x, i: ~F.array_contains(drop, i)), "\n")
    return met, F.size(drop).cast("long"), F.when(F.size(drop) == 0, docs[text]).otherwise(left)


def deduplicate(docs: DataFrame, min_words: int = MIN_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_lines, n_removed and kept_text.

    Lines are split at newlines. A line of at least ``min_words`` words goes if a line near it (at most
    one word put in, left out or replaced; equal lines included) stands earlier: in a smaller doc_id, or
    higher up in the same document. Lines are judged on the input, so a line may go for one that goes
    itself. Shorter lines stay. Null texts have no lines and stay null; null ids come first; rows that
    share an id are one document, whose lines count by their number in each row. An empty table gives no
    rows and other columns are ignored.
    """
    held = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    met, n_removed, left = _cut(held, min_words, "doc_id", "text")
    n = F.when(held["text"].isNull(), 0).otherwise(F.size(_lines(held["text"])))
    return met.select("doc_id", n.cast("long").alias("n_lines"), n_removed.alias("n_removed"), left.alias("kept_text"))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the lines that go cut out of ``text``, and ``n_chars`` counted anew where there is
    such a column. Documents of which no word is left go, if they had any.

    Null and empty texts and texts that lose nothing stay as they are; of equal lines the one of the least
    doc_id (null first), then the highest up, stays; rows that share an id are one document. An empty table
    stays empty; other columns ride along, whatever their names."""
    met, n_removed, left = _cut(docs, min_words, "doc_id", "text")
    kind, (rest,) = dict(docs.dtypes), free(docs, "__left")
    out = met.where((n_removed == 0) | left.rlike(r"[^\x20\x09-\x0D]")).withColumn(rest, left)
    n_chars = F.when(n_removed == 0, docs["n_chars"]).otherwise(F.length(rest).cast(kind["n_chars"])) if "n_chars" in kind else None
    cols = [F.col(rest).alias("text") if c == "text" else n_chars.alias("n_chars") if c == "n_chars" else docs[f"`{c}`"] for c in docs.columns]
    return out.select(*cols)
