"""Phrase collocation mining by pivot partitioning, as in MG-FSM.

Words that occur often enough get ids by falling frequency. For each place of a text, the word there is the
pivot of a fragment: it and the words round it that are more frequent, up to the longest phrase; rarer words
and words below the least frequency end it. A phrase belongs to its rarest word, the first one where it stands
several times, so every phrase occurrence lies in exactly one fragment round its owner. Fragments are routed to
their pivots, equal ones once with their number, and a pivot's phrases are counted there; only phrases that it owns
come out. A pivot of over ``SALT`` occurrences is dealt out by its fragments, and the counts of its phrases meet again.

Texts are read once: a task turns its texts into chunks of word numbers of their own, with the words and how often
each occurs. The vocabulary is made of these lists, and goes back to the chunks as ids. Nothing is held whole: a
chunk has about ``CHUNK`` words (one text at least), a pivot's share at most ``SALT`` fragments.

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` and split at spaces and tabs; a null text is empty, a null
language is ``und``. Repeated rows count as often as they stand there, ids are not used, columns of other names are
ignored, an empty table gives no rows. Equal scores go by the count, then by the phrase's bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.runtime import map_small, ranked, written

#: Words of a phrase; words of a chunk; occurrences of a pivot that one task may get; groups in which leaders are sought first.
LONGEST, CHUNK, SALT, GROUPS = 4, 1 << 20, 1 << 18, 16
_SPAN = LONGEST - 1  # three, so both sides of a fragment fill three longs
_WIDTH = 2 * _SPAN + 1
_CUT = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


class _Numbers(dict):
    """Words and their numbers, in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Chunk:
    """Texts of one language as word numbers: 0 ends a piece, 1 is nothing."""

    def __init__(self):
        self.known, self.parts, self.n = _Numbers({b"\n": 0, b"": 1}), [], 0

    def add(self, text: str) -> None:
        words = text.encode().translate(_CUT).replace(b"\n", b" \n ").split(b" ")
        got = np.fromiter(map(self.known.__getitem__, words), dtype=np.int32, count=len(words))
        got = got[got != 1]
        self.parts += [got, np.zeros(1, dtype=np.int32)]
        self.n += len(got) + 1

    def row(self, number: int, lang: str):
        stream = np.concatenate(self.parts)
        counts = np.bincount(stream, minlength=len(self.known))
        words = [w.decode() for w in self.known]
        return number, lang, words[2:], counts[2:].tolist(), (stream.astype("<u2") if len(words) < 1 << 16 else stream.astype("<i4")).tobytes()


def _chunks(docs: DataFrame, text: str, lang: str, chunk: int) -> DataFrame:
    """(chunk, lang, words, counts, stream): the numbers of a stream stand for the words from 2 on."""

    def run(frames):
        import pandas as pd
        from pyspark import TaskContext

        held, number = {}, TaskContext.get().partitionId() << 32

        def out(langs):
            nonlocal number
            rows = []
            for x in langs:
                rows.append(held.pop(x).row(number, x))
                number += 1
            return pd.DataFrame(rows, columns=["chunk", "lang", "words", "counts", "stream"])

        for frame in frames:
            for x, t in zip(frame["lang"], frame["text"], strict=True):
                held.setdefault(x, _Chunk()).add(t)
                if held[x].n >= chunk:
                    yield out([x])
            if sum(c.n for c in held.values()) >= 4 * chunk:
                yield out(list(held))
        if held:
            yield out(list(held))

    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return map_small(rows, run, "chunk long, lang string, words array<string>, counts array<long>, stream binary")


def _merged(rows: np.ndarray, n: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal neighbours in the order of ``key``, a hash of the rows, become one; rows whose hashes meet stay apart."""
    order = np.argsort(key, kind="stable")
    rows, n, key = rows[order], n[order], key[order]
    same = key[1:] == key[:-1]
    same[same] = (rows[1:][same] == rows[:-1][same]).all(1)
    at = np.flatnonzero(np.concatenate([[True], ~same])) if len(rows) else np.zeros(0, dtype=np.int64)
    return rows[at], np.add.reduceat(n, at) if len(at) else n, key[at]


def _hash(words: np.ndarray) -> np.ndarray:
    h = np.zeros(len(words), dtype=np.uint64)
    for c in words.T:
        h = (h ^ c.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _coded(chunks: DataFrame, spelt: DataFrame, known: DataFrame, share: int) -> DataFrame:
    """(stream, word, more) with the rows of a chunk in turn: its words that are known, word being place << 32 | id and more into
    how many shares more than one it goes, then its stream, where word says whether its numbers are wide. A list of a
    chunk's words would stand in a task's heap for all chunks that the task gets; sorted rows spill."""
    wide = (F.size("words") + 2 >= 1 << 16).cast("long")
    streams = chunks.select("chunk", "stream", wide.alias("word"), F.lit(0).cast("long").alias("more"))
    met = spelt.join(known, ["lang", "word"])
    words = met.select("chunk", F.lit(None).cast("binary").alias("stream"), F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("id").cast("long")).alias("word"), F.floor(F.col("f") / share).cast("long").alias("more"))
    return streams.unionByName(words).repartition("chunk").sortWithinPartitions("chunk", F.isnotnull("stream")).select("stream", "word", "more")


def _fragments(coded: DataFrame) -> DataFrame:
    """(key, x, y, z, n) from the rows of ``_coded``. key is the pivot's id and its salt, x to z the ids of three words before
    and three after it, -1: nothing, two to a long."""

    def run(batches):
        import pyarrow as pa

        held = []
        for b in batches:
            word, more = (b.column(c).to_numpy() for c in ("word", "more"))
            lo = 0
            for i in np.flatnonzero(b.column("stream").is_valid().to_numpy(zero_copy_only=False)):
                held.append((word[lo:i], more[lo:i]))
                lo = i + 1
                words, shares = (np.concatenate(x) for x in zip(*held, strict=True))
                held = []
                if len(words):
                    stream = np.frombuffer(b.column("stream")[int(i)].as_py(), dtype="<i4" if word[i] else "<u2")
                    at = (words >> 32) + 2
                    to = np.full(int(max(at.max(), stream.max())) + 1, -1, dtype=np.int32)
                    to[at] = (words & 0xFFFFFFFF).astype(np.int32)
                    salts = np.zeros(len(to), dtype=np.int64)
                    salts[at] = shares
                    yield from _cut(to[stream], salts[stream], pa)
            held.append((word[lo:].copy(), more[lo:].copy()))

    return coded.mapInArrow(run, "key long, x long, y long, z long, n long")


def _cut(seq: np.ndarray, salts: np.ndarray, pa):
    """The fragments of a stream of ids; ``salts``: into how many shares more than one the pivot there goes."""
    edge = np.full(_SPAN, -1, dtype=np.int32)
    line = np.concatenate([edge, seq, edge])
    sides = [*range(_SPAN - 1, -1, -1), *range(_SPAN + 1, _WIDTH)]
    w = np.full((len(seq), 2 * _SPAN), -1, dtype=np.int32)
    on = held = seq >= 0
    for turn, i in enumerate(sides):
        if turn == _SPAN:
            on = held
        word = line[i : i + len(seq)]
        on = on & (word >= 0) & (word < seq if turn < _SPAN else word <= seq)
        w[on, i if i < _SPAN else i - 1] = word[on]
    keep = (w[:, _SPAN - 1] >= 0) | (w[:, _SPAN] >= 0)
    rows = np.concatenate([seq[keep, None].astype(np.int64), w[keep].view(np.int64)], axis=1)
    more = salts[keep]
    order_key = _hash(rows)
    salt = np.where(more > 0, 1 + ((order_key >> np.uint64(7)) % (more + 1).astype(np.uint64)).astype(np.int64), 0)
    rows[:, 0] = (rows[:, 0] << 32) | salt
    rows, n, _ = _merged(rows, np.ones(len(rows), dtype=np.int64), order_key)
    for lo in range(0, len(rows), 1 << 17):
        part = slice(lo, lo + (1 << 17))
        yield pa.RecordBatch.from_arrays([*[pa.array(np.ascontiguousarray(c[part])) for c in rows.T], pa.array(n[part])], ["key", "x", "y", "z", "n"])


def _owned(rows: np.ndarray, n: np.ndarray, split: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The phrases (w0..w3), their counts and whether other tasks may count them too, of all fragments of some pivots' shares.

    Pairs of a pivot and its neighbour come first; where one is too rare, no longer phrase holds it, and that side goes."""
    phrases, counts, parts = [], [], []

    def count(grams, m, s):
        if not len(grams):
            return grams, m, s
        order = np.lexsort((*grams.T[::-1], s))
        grams, m, s = grams[order], m[order], s[order]
        new = np.concatenate([[True], (grams[1:] != grams[:-1]).any(1) | (s[1:] != s[:-1])])
        at = np.flatnonzero(new)
        m, back = np.add.reduceat(m, at), np.cumsum(new) - 1
        keep = (m >= least) | s[at]
        phrases.append(grams[at][keep]), counts.append(m[keep]), parts.append(s[at][keep])
        rare = np.zeros(len(order), dtype=bool)
        rare[order] = ~keep[back]
        return rare

    def take(lo, hi):
        on = (rows[:, lo] >= 0) & (rows[:, hi] >= 0)
        out = np.full((int(on.sum()), LONGEST), -1, dtype=np.int32)
        out[:, : hi - lo + 1] = rows[on, lo : hi + 1]
        return on, out

    for lo, hi, cut in ((_SPAN - 1, _SPAN, slice(0, _SPAN)), (_SPAN, _SPAN + 1, slice(_SPAN + 1, _WIDTH))):
        on, grams = take(lo, hi)
        if len(grams):
            rare = count(grams, n[on], split[on])
            rows[np.flatnonzero(on)[rare], cut] = -1
    for size in range(3, LONGEST + 1):
        for lo in range(_SPAN - size + 1, _SPAN + 1):
            on, grams = take(lo, lo + size - 1)
            if len(grams):
                count(grams, n[on], split[on])
    if not phrases:
        return np.zeros((0, LONGEST), dtype=np.int32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    return np.concatenate(phrases), np.concatenate(counts), np.concatenate(parts)


def _mined(fragments: DataFrame, least: int, share: int) -> DataFrame:
    """(w0, w1, w2, w3, f): the phrases of two words and more that occur ``least`` times, by their words' ids, -1 beyond the end."""
    words = [f"w{i}" for i in range(LONGEST)]
    dealt = fragments.repartition("key").sortWithinPartitions("key")

    def run(batches):
        import pyarrow as pa

        def out(held):
            key, sides, n = (np.concatenate(x) for x in zip(*held, strict=True))
            sides = sides.view(np.int32)
            rows = np.concatenate([sides[:, :_SPAN], (key >> 32).astype(np.int32)[:, None], sides[:, _SPAN:]], axis=1)
            rows, n, s = _owned(rows, n, (key & 0xFFFFFFFF) > 0, least)
            for lo in range(0, len(rows), 1 << 17):
                yield pa.RecordBatch.from_arrays([*[pa.array(c[lo : lo + (1 << 17)]) for c in rows.T], pa.array(n[lo : lo + (1 << 17)]), pa.array(s[lo : lo + (1 << 17)])], [*words, "f", "shared"])

        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            key, n = b.column("key").to_numpy(), b.column("n").to_numpy()
            sides = np.stack([b.column(c).to_numpy() for c in "xyz"], axis=1)
            # a pivot's share that goes on in the next batch stays
            ends = np.flatnonzero(key[1:] != key[:-1])
            first = bool(held) and held[-1][0][-1] != key[0]
            if size >= share and (first or len(ends)):
                cut = 0 if first and not len(ends) else int(ends[-1]) + 1
                if cut:
                    held.append((key[:cut], sides[:cut], n[:cut]))
                yield from out(held)
                held, size = [], 0
                key, sides, n = key[cut:], sides[cut:], n[cut:]
            held.append((key, sides, n))
            size += len(key)
        if held:
            yield from out(held)

    made = dealt.mapInArrow(run, ", ".join([*[f"{w} int" for w in words], "f long", "shared boolean"]))
    made = written(made)
    whole = made.where("not shared").select(*words, "f")
    return whole.unionByName(made.where("shared").groupBy(*words).agg(F.sum("f").alias("f")).where(F.col("f") >= least))


def _leaders(rows: DataFrame, by: str, order: list[Column], most: int, spread: Column) -> DataFrame:
    """The first ``most`` rows of each ``by``, with their rank: of groups of it by ``spread``, then of those."""
    first = F.row_number().over(Window.partitionBy(by, "__group").orderBy(*order))
    few = rows.withColumn("__group", F.pmod(spread, F.lit(GROUPS))).withColumn("__n", first).where(F.col("__n") <= most).drop("__n", "__group")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("long")).where(F.col("rank") <= most)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, most: int | None = 2_000, cover: int = 80, chunk: int = CHUNK, share: int = SALT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) for each language: phrases of two to four words that stand ``least`` times in
    its texts, a times; n words in all. A cut after the first words gives the counts l and r of both sides and the score
    floor(2000000 a / (l + r)), exactly; a phrase has that of its worst cut, the first of equal ones. Phrases inside a longer
    one that has ``cover`` percent of their occurrences go. ``most``: so many of each language; None: all, without rank.
    ``chunk`` and ``share`` bound what a task holds and don't change the rows."""
    words = [f"w{i}" for i in range(LONGEST)]
    # a chunk is megabytes, and what writes or reads Parquet holds a row group
    chunks = written(_chunks(docs, text, lang, chunk), codec="zstd", group=4)
    totals = chunks.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    spelt = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "x")).select("chunk", "lang", "at", F.col("x.words").alias("word"), F.col("x.counts").alias("c"))
    often = spelt.groupBy("lang", "word").agg(F.sum("c").alias("f")).where(F.col("f") >= least).withColumn("down", -F.col("f"))
    known = written(ranked(often, ["down", "lang", "word"], "id").select("lang", "word", "f", F.col("id").cast("int").alias("id")))
    grams = written(_mined(_fragments(_coded(chunks, spelt, known, share)), least, share))

    single = known.select(F.col("id").alias("w0"), *[F.lit(-1).alias(w) for w in words[1:-1]], "f", "lang")
    shorter = single.unionByName(grams.where("w3 = -1").select(*words[:-1], "f", F.lit(None).cast("string").alias("lang")))
    size = F.lit(1)
    for w in words[1:]:
        size = size + (F.col(w) >= 0).cast("int")
    sized = grams.withColumnRenamed("f", "a").withColumn("size", size)

    def part(lo: Column, hi: Column) -> Column:
        """The words from lo to before hi."""
        at = F.array(*words)
        return F.struct(*[F.when(lo + i < hi, F.get(at, lo + i)).otherwise(-1).alias(w) for i, w in enumerate(words[:-1])])

    # both sides of each cut meet the counts
    cuts = sized.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    sides = cuts.select(*words, "a", "k", F.explode(F.array(F.struct(F.lit(True).alias("left"), part(F.lit(0), F.col("k")).alias("p")), F.struct(F.lit(False).alias("left"), part(F.col("k"), F.col("size")).alias("p")))).alias("s"))
    keyed = sides.select(*[F.col(w).alias(f"g{i}") for i, w in enumerate(words)], "a", "k", "s.left", "s.p.*")
    met = keyed.join(shorter, words[:-1]).groupBy(*[f"g{i}" for i in range(LONGEST)], "a").agg(
        *[F.max(F.when((F.col("k") == k) & side, F.col("f"))).alias(f"{c}{k}") for k in range(1, LONGEST) for c, side in (("l", F.col("left")), ("r", ~F.col("left")))], F.max("lang").alias("lang")
    )
    exact = lambda k: (F.lit(2_000_000).cast("decimal(7,0)") * F.col("a").cast("decimal(20,0)"), (F.col(f"l{k}") + F.col(f"r{k}")).cast("decimal(20,0)"))
    score = lambda k: F.when(F.col(f"l{k}").isNotNull(), F.struct(F.call_function("div", *exact(k)).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    scored = met.withColumn("x", F.least(*[score(k) for k in range(1, LONGEST)])).select(*[F.col(f"g{i}").alias(w) for i, w in enumerate(words)], "a", "lang", "x.score", "x.l", "x.r")

    # what longer phrases hold, by their most frequent
    inner = sized.where("size > 2").select("a", "size", *words, F.explode(F.expr(f"filter(flatten(transform(sequence(0, {LONGEST - 2}), lo -> transform(sequence(lo + 2, {LONGEST}), hi -> struct(lo, hi)))), x -> x.hi <= size and x.hi - x.lo < size)")).alias("x"))
    held = inner.select(part(F.col("x.lo"), F.col("x.hi")).alias("p"), "a").select("p.*", "a").groupBy(*words[:-1]).agg(F.max("a").alias("longer")).withColumn("w3", F.lit(-1))
    kept = scored.join(held, words, "left").where(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a"))).drop("longer")
    if most is not None:  # words are looked up only for what may be among the first, ties included
        kept = written(kept)
        bar = _leaders(kept.select("lang", "score", "a", F.xxhash64(*words).alias("h")), "lang", [F.desc("score"), F.desc("a")], most, F.col("h"))
        bar = bar.groupBy("lang").agg(F.min(F.struct("score", "a")).alias("bar"))
        kept = kept.join(bar, "lang").where(F.struct("score", "a") >= F.col("bar")).drop("bar")
    spelled = kept
    for i, w in enumerate(words):
        spelled = spelled.join(known.select(F.col("id").alias(w), F.col("word").alias(f"s{i}")), w, "left")
    out = spelled.select("lang", F.concat_ws(" ", *[f"s{i}" for i in range(LONGEST)]).alias("phrase"), "a", "l", "r", "score")
    if most is not None:
        out = _leaders(out, "lang", [F.desc("score"), F.desc("a"), F.col("phrase")], most, F.xxhash64("phrase"))
    return out.join(totals, "lang").select("lang", *["rank"] * (most is not None), "phrase", "a", "l", "r", "n", "score")
