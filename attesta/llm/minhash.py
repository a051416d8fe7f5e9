"""MinHash near-duplicates by tensored banding.

A text's set is its distinct shingles of ``WORDS`` words. Two small collections of ``side`` half keys
each, a half key made of ``ROWS`` minima, give side x side tables: the key of table (i, j) combines half
key i of the first collection with half key j of the second. So side² tables of 2 ROWS minima cost
2 side ROWS minima instead of 2 side² ROWS. Texts of Jaccard similarity s meet in some table unless no
half key of one side agrees: a chance of at most 2 (1 - s^ROWS)^side. ``side`` is the least that keeps
this below ``MISS`` at the threshold: 8 at 0.85, where it is 0.1 %, and 0.003 % at 0.9. Where ``ROWS``
minima would take more than ``MAX_SIDE`` half keys, half keys have fewer minima; thresholds that not even
single minima serve are refused.

Equal sets are one class from the start. Tables send on one link a class, to the least class of its
key, which tasks find for their own rows before anything is shuffled, so a key that a third of all rows
share costs a row for each task. Links whose ends share far fewer minima than near texts do are refused, and what
the others connect forms groups. In a key with a refused link between two groups the least class does not stand for
the others: there all classes of different groups are compared by their minima, in blocks two by two, and those that
are alike join their groups. Within a group, pairs that meet in a table are confirmed on their
full sets, in blocks of bounded size: first within each block, then between one text of each part that
this left, then, only where a group is still in parts, between all blocks two by two, across parts. The texts
of such groups' members are fetched once, by their ids, and only they are dealt out after that.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.runtime import LONG_MIN, components, drop, free, map_small, tasks_for, worker_cache, written

WORDS = 5
ROWS, MISS, MAX_SIDE = 3, 2e-3, 32
#: Texts, and shingles, of a block.
BLOCK, BLOCK_SHINGLES = 128, 1 << 20
#: Classes of a block of a key with refused links.
KEY_BLOCK = 2048
#: Classes whose table keys a task makes at once: each has side x side of them, at some 120 bytes while they are sorted.
KEYED = 1024
#: Rows' keys of two longs that may be broadcast: some 40 bytes each as a hash table, so at most 40 MB.
BROADCAST_KEYS = 1_000_000
#: Bytes of text for a shingle, about.
SHINGLE_BYTES = 8
#: Bytes of text hashed at once.
AT_ONCE = 1 << 18

_U = np.uint64
_rng = np.random.default_rng(20_240_229)
_BYTE = _rng.integers(0, 2**63, 256, dtype=_U) * _U(2) + _U(1)
_PLACE = _rng.integers(0, 2**63, WORDS, dtype=_U) * _U(2) + _U(1)
_MIN = _rng.integers(0, 2**63, (2, MAX_SIDE, ROWS), dtype=_U) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(31))
    h = h * _U(0x7FB5D329728EA185)
    h = h ^ (h >> _U(27))
    h = h * _U(0x81DADEF4BC2DD44D)
    return h ^ (h >> _U(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n and more of each."""
    held = worker_cache("minhash")
    if len(held.get("powers", ((),))[0]) < n:
        size, base = max(n, 2 * AT_ONCE), int(_BASE) | 1
        out = np.full((2, size), base, dtype=_U)
        out[1] = pow(base, -1, 2**64)
        out[:, 0] = 1
        held["powers"] = tuple(np.multiply.accumulate(x) for x in out)
    return held["powers"]


class Shingler:
    """Distinct shingle hashes of texts, many at once."""

    def __init__(self, words: int = WORDS):
        self.words = words

    def sets(self, texts: list[str | None]):
        """For each text its sorted distinct shingle hashes; texts without words have none."""
        lo = 0
        while lo < len(texts):
            hi, parts, size = lo, [], 0
            while hi < len(texts) and size < AT_ONCE:
                parts.append((texts[hi] or "").encode("utf-8", "surrogatepass").lower())
                size += len(parts[-1]) + 1
                hi += 1
            yield from self._chunk(parts)
            lo = hi

    def _chunk(self, parts: list[bytes]):
        raw = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
        up, down = _powers(len(raw) + 1)
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        inner = np.concatenate([[True], space])
        starts = np.flatnonzero(inner[:-1] & ~inner[1:])
        ends = np.flatnonzero(~inner[:-1] & inner[1:])
        sums = np.zeros(len(raw) + 1, dtype=_U)
        np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
        word = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
        bounds = np.cumsum([len(p) + 1 for p in parts])
        first = np.searchsorted(starts, np.concatenate([[0], bounds[:-1]]))
        last = np.searchsorted(starts, bounds)
        k = self.words
        if len(word) >= k:
            shingle = np.zeros(len(word) - k + 1, dtype=_U)
            for i in range(k):
                shingle += word[i : len(word) - k + 1 + i] * _PLACE[i]
            shingle = _mix(shingle)
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            if b - a >= k:
                yield np.unique(shingle[a : b - k + 1])
            elif b > a:  # the whole sequence is the only shingle
                yield _mix((word[a:b] * _PLACE[: b - a]).sum(keepdims=True) + _U(b - a))
            else:
                yield np.zeros(0, dtype=_U)


def plan(percent: int) -> tuple[int, int]:
    """(minima of a half key, half keys of a side) for a threshold."""
    for rows in range(ROWS, 0, -1):
        side = max(1, math.ceil(math.log(MISS / 2) / math.log(1 - min(0.999, percent / 100) ** rows)))
        if side <= MAX_SIDE:
            return rows, side
    raise ValueError(f"a threshold of {percent} % is too low for tables")


def minima(shingles: np.ndarray, side: int, rows: int = ROWS) -> np.ndarray:
    """The minima of both collections."""
    factors = _MIN[:, :side, :rows].ravel()
    if len(shingles) <= 4096:
        v = shingles[None] * factors[:, None]
        v ^= v >> _U(32)
        least = v.min(1)
    else:
        least = np.empty(len(factors), dtype=_U)
        for i, m in enumerate(factors):
            v = shingles * m
            v ^= v >> _U(32)
            least[i] = v.min()
    return least


def half_keys(least: np.ndarray, side: int) -> np.ndarray:
    """The half keys of both collections, as 2 x side longs."""
    rows = least.reshape(2, side, -1)
    key = np.zeros((2, side), dtype=_U)
    for r in range(rows.shape[2]):
        key = _mix(key * _BASE + rows[:, :, r])
    return key.view(np.int64)


def _tables(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(n, side) half keys of each collection -> (n, side x side) keys, each salted by its table."""
    side = np.arange(a.shape[1], dtype=_U)
    i, j = side[None, :, None], side[None, None, :]
    with np.errstate(over="ignore"):
        out = _mix(a.view(_U)[:, :, None] * _BASE + i) ^ (_mix(b.view(_U)[:, None, :] + j) * _U(0xC2B2AE3D27D4EB4F))
    return _mix(out).reshape(len(a), -1).view(np.int64)


def _sketch(words: int, side: int, rows: int):
    def run(batches):
        shingler = Shingler(words)
        for b in batches:
            n, one, two, left, right, marks = [], [], [], [], [], []
            for s in shingler.sets(b["text"].tolist()):
                n.append(len(s))
                if len(s):
                    least = minima(s, side, rows)
                    keys = half_keys(least, side)
                    marks.append((least >> _U(16) & _U(0x7FFF)).astype(np.int16))
                    one.append(int(s.sum().view(np.int64)))
                    two.append(int(_mix(s ^ _BASE).sum().view(np.int64)))
                    left.append(keys[0])
                    right.append(keys[1])
                else:
                    one.append(0)
                    two.append(0)
                    left.append(None)
                    right.append(None)
                    marks.append(None)
            yield pd.DataFrame({"id": b["id"], "h": b["h"], "n": n, "one": one, "two": two, "ka": left, "kb": right, "marks": marks})

    return run


def _meet(batches):
    """Per batch: for each table key the least class, and a link to it from each other class."""
    for b in batches:
        if not len(b):
            continue
        ids = b["rep"].to_numpy()
        keys = _tables(np.stack(b["ka"].to_numpy()), np.stack(b["kb"].to_numpy())).ravel()
        ids = np.repeat(ids, len(keys) // len(ids))
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        head = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
        link = ids != head
        none = pd.arrays.IntegerArray(np.zeros(int(new.sum()), dtype=np.int64), np.ones(int(new.sum()), dtype=bool))
        yield pd.DataFrame({"key": keys[new], "id": ids[new], "other": none})
        if link.any():
            yield pd.DataFrame({"key": keys[link], "id": ids[link], "other": pd.array(head[link], dtype="Int64")})


def _linked(met: DataFrame) -> DataFrame:
    """(key, id, other): the links of ``_meet``, and one from each batch's head of a key to the least of them. A key has a
    head from each batch at most, so its window is short however many rows share it."""
    heads = met.where("other is null").select("key", "id")
    least = heads.withColumn("other", F.min("id").over(Window.partitionBy("key"))).where("id <> other")
    return met.where("other is not null").unionByName(least)


def _confirm(ids: np.ndarray, label: np.ndarray, sets: list[np.ndarray], half: np.ndarray | None, percent: int):
    """Links enough to connect what is connected: breadth-first over pairs that meet in a table and
    whose sets reach 100 * intersection >= percent * union. label: pairs of one label are connected
    already; half: pairs cross its two values."""
    n = len(ids)
    rows, side = plan(percent)
    size = np.array([len(s) for s in sets])
    keys = np.stack([half_keys(minima(s, side, rows), side) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), size)
    start = np.cumsum(size) - size
    open_ = np.ones(n, dtype=bool)
    links = []
    for seed in range(n):
        if not open_[seed]:
            continue
        open_[seed] = False
        queue = [seed]
        while queue:
            u = queue.pop()
            near = open_ & (100 * np.minimum(size, size[u]) >= percent * np.maximum(size, size[u]))
            near &= label != label[u]
            if half is not None:
                near &= half != half[u]
            cand = np.flatnonzero(near)
            if len(cand):
                met = (keys[cand] == keys[u]).any(2).all(1)
                cand = cand[met]
            if not len(cand):
                continue
            if len(cand) > 0.2 * n:
                common = np.bincount(owner, _member(flat, sets[u]), n)[cand]
            else:
                picked = np.concatenate([flat[start[c] : start[c] + size[c]] for c in cand])
                common = np.add.reduceat(_member(picked, sets[u]).astype(np.int64), np.cumsum(size[cand]) - size[cand])
            hit = cand[100 * common >= percent * (size[cand] + size[u] - common)]
            open_[hit] = False
            links += [(ids[u], ids[h]) for h in hit]
            queue += hit.tolist()
    return links


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def _need(percent: int) -> int:
    """Minima that two texts share for a link: what texts at the threshold do, all but five standard deviations."""
    rows, side = plan(percent)
    n, s = 2 * side * rows, percent / 100
    return math.floor(n * s - 5 * math.sqrt(n * s * (1 - s)))


def _alike(edges: DataFrame, classes: DataFrame, need: int) -> DataFrame:
    """Links of a table with ok: whether their ends share about as many minima as near texts do. Texts that
    share no more than a common passage meet in a table now and then; without this, such links would tie them
    all into one group."""
    a = classes.select(F.col("rep").alias("id"), F.col("marks").alias("ma"))
    b = classes.select(F.col("rep").alias("other"), F.col("marks").alias("mb"))
    shared = F.size(F.filter(F.zip_with("ma", "mb", lambda x, y: x == y), lambda x: x))
    return edges.join(a, "id").join(b, "other").select("id", "other", (shared >= need).alias("ok"))


def _kin(ids: np.ndarray, label: np.ndarray, size: np.ndarray, marks: np.ndarray, half: np.ndarray | None, need: int, percent: int):
    """Links enough to connect, across labels, all that share ``need`` minima and could be near by their
    sizes; half: pairs cross its two values."""
    _, label, count = np.unique(label, return_inverse=True, return_counts=True)
    links = []
    for u in np.flatnonzero(label != count.argmax()):
        open_ = (label != label[u]) & (100 * np.minimum(size, size[u]) >= percent * np.maximum(size, size[u]))
        if half is not None:
            open_ &= half != half[u]
        cand = np.flatnonzero(open_)
        for v in cand[(marks[cand] == marks[u]).sum(1) >= need]:
            if label[v] != label[u]:
                links.append((ids[u], ids[v]))
                label[label == label[v]] = label[u]
    return links


def _dealt(rows: DataFrame, by: str, id: str, blocks, across: bool = True) -> DataFrame:
    """The rows (by, id, label, n) with mine, their block in the group of ``by``, and first and last, the blocks that
    mine meets: itself, or with ``across`` all that it must be compared with. blocks: their number for a count of rows
    and a sum of n. Rows of one label need no comparing, so those of a large group's most frequent label have blocks of
    their own that meet only the others': where one label is nearly all of a group, the work grows in proportion to it."""
    sums = [F.count("*").alias("c"), F.sum("n").alias("s")]
    c, s, most = F.col("c"), F.col("s"), F.col("most")
    if across:
        each = rows.groupBy(by, "label").agg(*sums)
        large = each.groupBy(by).agg(F.sum("c").alias("c"), F.sum("s").alias("s"), F.max(F.struct("c", "s", "label")).alias("most")).where(blocks(c, s) > 1)
        large = large.select(by, most["label"].alias("main"), blocks(most["c"], most["s"]).alias("mains"), F.greatest(F.lit(1), blocks(c - most["c"], s - most["s"])).alias("others"))
    else:
        large = rows.groupBy(by).agg(*sums).where(blocks(c, s) > 1).select(by, F.lit(None).cast("long").alias("main"), F.lit(0).alias("mains"), blocks(c, s).alias("others"))
    held, at = F.col("others").isNotNull(), F.xxhash64(id)
    is_main = F.col("label") == F.col("main")
    mine = F.when(is_main, F.col("others") + F.pmod(at, F.col("mains"))).when(held, F.pmod(at, F.col("others"))).otherwise(0).cast("int")
    last = F.when(is_main, F.col("others") - 1).when(held, F.col("others") + F.col("mains") - 1).otherwise(0).cast("int")
    out = rows.join(written(large), by, "left").withColumn("mine", mine)  # a file, so that rows are not dealt out by group
    return out.withColumn("first", F.lit(0) if across else F.col("mine")).withColumn("last", last if across else F.col("mine")).drop("main", "mains", "others")


def _partners():
    """The pairs of blocks x and y that a row of ``_dealt`` is in."""
    return F.inline(F.transform(F.sequence("first", "last"), lambda o: F.struct(F.least(o, F.col("mine")).alias("x"), F.greatest(o, F.col("mine")).alias("y"))))


def _refused(links: DataFrame, judged: DataFrame, groups: DataFrame, classes: DataFrame, need: int, percent: int) -> DataFrame:
    """Links (a, b) between alike classes of different groups that meet in a key where a link was refused:
    all classes of such a key but those of one group are compared, in blocks two by two."""
    label = groups.select(F.col("node").alias("id"), F.col("component").alias("label"))
    head = label.select(F.col("id").alias("other"), F.col("label").alias("head"))
    apart = judged.where("not ok").join(label, "id", "left").join(head, "other", "left").where(F.coalesce("label", "id") != F.coalesce("head", "other"))
    keys = links.join(apart.select("id", "other"), ["id", "other"]).select("key").distinct()
    # every class of a key but the least has one link in it, and the least has none
    met = written(links.join(keys, "key", "left_semi"))
    held = met.select("key", "id").unionByName(met.groupBy("key").agg(F.min("other").alias("id")))
    held = held.join(label, "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"), F.lit(1).alias("n"))
    dealt = written(_dealt(written(held), "key", "id", lambda c, _: F.ceil(c / KEY_BLOCK)))
    size = dealt.agg(F.sum(F.col("last") + 1)).first()[0] or 0
    placed = dealt.drop("n").join(classes.select(F.col("rep").alias("id"), "n", "marks"), "id").select("key", "id", "n", "label", "marks", "mine", _partners())
    placed = placed.select(F.xxhash64("key", "x", "y").alias("h"), "*")
    placed = placed.repartition(tasks_for(links.sparkSession, size * 300), "h").sortWithinPartitions("h", "key", "x", "y")

    def block(b, bounds):
        found = []
        ids, label, size, mine = (b[c].to_numpy() for c in ("id", "label", "n", "mine"))
        marks, x, y = np.stack(b["marks"].to_numpy()), b["x"].to_numpy(), b["y"].to_numpy()
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            half = mine[lo:hi] if x[lo] != y[lo] else None
            found += _kin(ids[lo:hi], label[lo:hi], size[lo:hi], marks[lo:hi], half, need, percent)
        if found:
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64").drop_duplicates()

    return map_small(placed, lambda batches: _by_block(batches, ["h", "key", "x", "y"], block), "a long, b long", rows=2 * KEY_BLOCK)


def _by_block(batches, by: list[str], block):
    """What ``block`` yields for frames of whole runs of the columns ``by``, and the bounds of the runs."""
    rest = None
    for b in batches:
        if rest is not None:
            b = pd.concat([rest, b], ignore_index=True)
        if not len(b):
            continue
        mark = b[by].to_numpy()
        bounds = [0, *(np.flatnonzero((mark[1:] != mark[:-1]).any(1)) + 1), len(b)]
        if len(bounds) > 2:
            yield from block(b, bounds[:-1])
        rest = b.iloc[bounds[-2] :].reset_index(drop=True)
    if rest is not None and len(rest):
        yield from block(rest, [0, len(rest)])


def _blocks(c, s):
    return F.greatest(F.ceil(c / F.lit(float(BLOCK))), F.ceil(s / F.lit(float(BLOCK_SHINGLES))))


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """The members with the part that the links put them in as label."""
    parts = components(links).select("node", F.col("component").alias("part"))
    return members.drop("label").join(parts, "node", "left").select("node", "component", "n", F.coalesce("part", "node").alias("label"))


def _fetched(read: DataFrame, members: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, text) of the members, each from the row that stands for its class. The rows' keys go to the texts
    where they are few, else both are dealt out by id; that happens once, and what follows reads these texts only."""
    keys = members.select("node").join(classes.select(F.col("rep").alias("node"), F.col("id").alias("__id"), F.col("h").alias("__h")), "node")
    keys = F.broadcast(keys) if members.count() <= BROADCAST_KEYS else keys
    return written(read.join(keys, (read["id"] == F.col("__id")) & (read["h"] == F.col("__h"))).select("node", "text"))


def _links(held: DataFrame, members: DataFrame, words: int, percent: int, across: bool) -> DataFrame:
    """Confirmed links (a, b) between members (node, component, n, label) of a component and of different
    labels: within the blocks of each component, or with ``across`` between its blocks too. held: (node, text)."""
    dealt = _dealt(members, "component", "node", _blocks, across)
    size = dealt.agg(F.sum(F.col("n") * (F.col("last") - F.col("first") + 1))).first()[0] or 0
    texts = held.join(dealt.drop("n"), "node").select("node", "component", "label", "mine", "text", _partners())
    texts = texts.select(F.xxhash64("component", "x", "y").alias("h"), "*")
    texts = texts.repartition(tasks_for(held.sparkSession, size * SHINGLE_BYTES), "h").sortWithinPartitions("h", "component", "x", "y")

    def solve(batches):
        shingler = Shingler(words)
        yield from _by_block(batches, ["h", "component", "x", "y"], lambda b, bounds: block(b, bounds, shingler))

    def block(b, bounds, shingler):
        links = []
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            if hi - lo > 1:
                part = b.iloc[lo:hi]
                sets = list(shingler.sets(part["text"].tolist()))
                full = np.array([len(s) > 0 for s in sets])
                if full.sum() > 1:
                    half = part["mine"].to_numpy()[full] if part["x"].iat[0] != part["y"].iat[0] else None
                    links += _confirm(part["node"].to_numpy()[full], part["label"].to_numpy()[full], [s for s in sets if len(s)], half, percent)
        if links:
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return map_small(texts, solve, "a long, b long", rows=2 * BLOCK)


def _judged(docs: DataFrame, percent: int, words: int, id: str, text: str) -> DataFrame:
    """(id, h, n, component, first_id, first_h) for each row: h is a hash of its text, first the least (id, h) of its
    component, component that row's id. A null id is ``LONG_MIN``."""
    rows, side = plan(percent)
    read = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(LONG_MIN)).alias("id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))
    sketches = written(map_small(read, _sketch(words, side, rows), "id long, h long, n long, one long, two long, ka array<long>, kb array<long>, marks array<short>"))
    some = sketches.where("n > 0")
    # classes have numbers of their own, as rows may share an id; id and h name the row that stands for one
    classes = some.groupBy("one", "two", "n").agg(F.min(F.struct("id", "h", "ka", "kb", "marks")).alias("m")).select("one", "two", "n", "m.id", "m.h", "m.ka", "m.kb", "m.marks")
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()))
    met = written(map_small(classes.select("rep", "ka", "kb"), _meet, "key long, id long, other long", rows=KEYED))
    links = written(_linked(met))
    drop(met)
    need = _need(percent)
    judged = written(_alike(links.select("id", "other").distinct(), classes, need))
    alike = judged.where("ok").select(F.col("id").alias("a"), F.col("other").alias("b"))
    groups = components(alike)
    if judged.where("not ok").limit(1).count():
        more = written(_refused(links, judged, groups, classes, need, percent))
        if more.limit(1).count():
            groups = components(alike.unionByName(more))
    members = written(groups.join(classes.select(F.col("rep").alias("node"), "n"), "node").select("node", "component", "n", F.col("node").alias("label")))
    drop(links, judged)
    held = _fetched(read, members, classes)
    # every block on its own, which settles groups of one block
    confirmed = written(_links(held, members, words, percent, False))
    large = members.groupBy("component").agg(_blocks(F.count("*"), F.sum("n")).alias("blocks")).where("blocks > 1").select("component")
    if large.limit(1).count():
        # then one of each part found in the large groups, which joins most parts
        parts = written(_labelled(members.join(large, "component", "left_semi"), confirmed))
        heads = written(_links(held, parts.where("node = label"), words, percent, True))
        parts = written(_labelled(parts, confirmed.unionByName(heads)))
        # and all members of the groups of which parts are left, across parts
        torn = parts.groupBy("component").agg((F.min("label") != F.max("label")).alias("torn")).where("torn").select("component")
        rest = written(_links(held, parts.join(torn, "component", "left_semi"), words, percent, True))
        confirmed = confirmed.unionByName(heads).unionByName(rest)
    whole = components(confirmed).withColumnRenamed("node", "rep")
    drop(held)
    named = classes.select("one", "two", F.col("n").alias("__n"), "rep", F.struct("id", "h").alias("own")).join(whole, "rep", "left")
    first = named.where("component is not null").groupBy("component").agg(F.min("own").alias("first"))
    final = named.join(first, "component", "left").select("one", "two", "__n", F.coalesce("first", "own").alias("first"))
    out = sketches.select("id", "h", "n", "one", "two").join(final, (sketches["one"] == final["one"]) & (sketches["two"] == final["two"]) & (sketches["n"] == final["__n"]), "left")
    return out.select("id", "h", "n", F.coalesce("first.id", "id").alias("component"), F.coalesce("first.id", "id").alias("first_id"), F.coalesce("first.h", "h").alias("first_h"))


def near_duplicates(docs: DataFrame, percent: int = 85, words: int = WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles (size of its set), component_id (least
    doc_id that links reach, its own included) and kept (doc_id = component_id).

    Words are runs without ASCII white space, A-Z in lower case; a set holds the distinct shingles of
    ``words`` words, of a shorter text the whole sequence. Texts link at 100 * intersection >=
    ``percent`` * union, counted on the full sets. Null texts and texts without words have an empty set
    and link with nothing. Rows are judged each by its own text, also where they share an id; a null id
    is smaller than all others, so component_id is null where a row of a null id is in the component. An
    empty table gives no rows; other columns are ignored.
    """
    out = _judged(docs, percent, words, id, text)
    return out.select(_id("id").alias("doc_id"), F.col("n").alias("n_shingles"), _id("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def _id(col):
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col != F.lit(LONG_MIN), col)


def without_near_duplicates(docs: DataFrame, percent: int = 80, words: int = WORDS) -> DataFrame:
    """``docs`` with one document of each component: that of the least doc_id (null first), and where rows share
    this id that of the least hash of its text; all columns stay.

    Rows of one id and one text are one document and stay or go together. A row goes by its own text, never
    for another row's that has its id. Null texts and texts without words stay, an empty table stays empty."""
    id, h = free(docs, "__gone_id", "__gone_h")
    gone = written(_judged(docs, percent, words, "doc_id", "text").where("id <> first_id or h <> first_h").select(F.col("id").alias(id), F.col("h").alias(h)).distinct())
    small = gone.count() <= BROADCAST_KEYS
    same = (F.coalesce(docs["doc_id"].cast("long"), F.lit(LONG_MIN)) == F.col(id)) & (F.xxhash64(docs["text"]) == F.col(h))
    return docs.join(F.broadcast(gone) if small else gone, same, "left_anti")
