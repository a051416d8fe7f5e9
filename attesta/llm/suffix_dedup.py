"""Repeated passages by merging Burrows-Wheeler transforms of shards.

A byte goes if a string of ``WIDTH`` bytes that covers it also starts earlier. Strings of that width
are found in three steps.

* Anchors. The least hashed gram of ``GRAM`` bytes in a window of ``WIDTH`` bytes is its anchor, a
  function of the window alone, so equal windows have equal anchors at equal places. A run of
  windows with one anchor is a snippet. Tasks drop snippets that they have met whole before anything
  is shuffled; over all tasks, equal snippets meet by (anchor, snippet) and all but the first go.
* Anchors that stand in one snippet only hold nothing that repeats. The snippets of all others are
  fetched and dealt out by anchor.
* A task's snippets are dealt into shards. Each shard has its suffixes sorted once and gives its
  Burrows-Wheeler transform. The transforms are merged by iterative interleave refinement: starting
  from the shards one after another, each round puts the symbols before the suffixes, in their present
  order, into a stable order, which sorts all suffixes by one symbol more; only the transforms and their
  last-to-first maps are read, and no suffix is compared. A symbol is ``STEP`` bytes. After WIDTH / STEP
  rounds neighbours are compared for their common prefix, and intervals of ``WIDTH`` common bytes are
  the repeated windows: the first in document order stays.

An anchor may have any number of different snippets. Where it has more than ``MOST``, they are cut into finer
ones by second anchors, the least hashed grams of more bytes, again functions of the window alone: windows that
share both anchors meet, equal finer snippets go by their marks, and what is left of a pair of anchors goes to
the merge, or is cut once more. The last grams are whole windows, so every group ends; no task holds an
anchor, and all sizes go by one method. Where marks meet, an anchor with much of a task's share of rows is dealt
out by its marks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.runtime import LONG_MIN, map_small, tasks_for, worker_cache, written

WIDTH, GRAM, STEP = 100, 20, 8
SHARDS, BATCH = 4, 1 << 17
#: Different snippets of an anchor that go to one merge; bytes of the second and later anchors.
MOST, FINER = 4_096, (50, 80, WIDTH)
#: Rows of an anchor, at least, and share of a task's rows from which it is dealt out by marks; one row in so many
#: is counted for that.
HEAVY, SHARE, EVERY = 1_024, 0.25, 16
#: Anchors, of two longs, that may be broadcast.
BROADCAST_ANCHORS = 1_000_000
#: Bytes of text handled at once; a place takes that many bits.
_BITS = 20
_U = np.uint64
_rng = np.random.default_rng(77)
_BYTE = _rng.integers(0, 2**63, 256, dtype=_U) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


class _Hasher:
    """Hashes of any substring of some bytes by one prefix sum."""

    def __init__(self, raw: np.ndarray):
        n = len(raw) + 1
        held = worker_cache("suffix")
        if len(held.get("suffix", ((),))[0]) < n:
            out = np.full((2, max(n, (1 << _BITS) + 2)), _BASE, dtype=_U)
            out[1] = pow(_BASE, -1, 2**64)
            out[:, 0] = 1
            held["suffix"] = tuple(np.multiply.accumulate(x) for x in out)
        up, self.down = held["suffix"]
        self.sums = np.zeros(n, dtype=_U)
        np.cumsum(_BYTE[raw] * up[: n - 1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])


def _snippets(raw: np.ndarray, bounds: np.ndarray, size: int = GRAM):
    """Snippets of documents laid end to end: (document, start, windows, anchor's place, anchor, hash)."""
    n = len(raw)
    if n < WIDTH:
        return None
    hashes = _Hasher(raw)
    at = np.arange(n - size + 1)
    gram = hashes(at, at + size)
    least = (gram >> _U(_BITS)) << _U(_BITS) | at.astype(_U)
    span, wide = 1, WIDTH - size + 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
    anchor = (least & _U((1 << _BITS) - 1)).astype(np.int64)
    start = np.arange(len(anchor))
    doc = np.searchsorted(bounds, start, "right") - 1
    whole = start + WIDTH <= bounds[doc + 1]
    first = whole.copy()
    first[1:] &= ~whole[:-1] | (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(first)
    if not len(begin):
        return None
    stop = np.flatnonzero(whole & np.concatenate([~whole[1:] | first[1:], [True]])) + 1
    windows, a = stop - begin, anchor[begin]
    mark = _mix(hashes(begin, stop - 1 + WIDTH) + (windows * 256 + (a - begin)).astype(_U))
    return doc[begin], begin - bounds[doc[begin]], windows, a - begin, gram[a].view(np.int64), mark.view(np.int64)


def _chunks(texts):
    """(numbers, starts, bytes, bounds): texts laid end to end; a huge one in overlapping parts."""
    limit, held, size = (1 << _BITS) - 1, [], 0

    def lay():
        bounds = np.cumsum([0, *(len(p) for _, _, p in held)])
        return np.array([i for i, _, _ in held]), np.array([s for _, s, _ in held]), np.frombuffer(b"".join(p for _, _, p in held), np.uint8), bounds

    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        for lo in range(0, max(1, len(data) - WIDTH + 1), limit - WIDTH):
            part = data[lo : lo + limit - 1]
            if size + len(part) > limit and held:
                yield lay()
                held, size = [], 0
            held.append((i, lo, part))
            size += len(part)
    if held:
        yield lay()


_RUNS = "doc long, row long, pos int, windows int"
_FOUND = "run boolean, anchor long, mark long, doc long, row long, pos int, windows int"


def _deduped(anchor, mark, doc, row, pos, windows, data=None) -> pd.DataFrame:
    """The first of equal snippets, and runs of windows for the others, which go."""
    order = np.lexsort((pos, doc, mark, anchor))
    anchor, mark, doc, row, pos, windows = (x[order] for x in (anchor, mark, doc, row, pos, windows))
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (mark[1:] != mark[:-1])])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = ~new & ((doc != doc[lead]) | (pos != pos[lead]))
    out = pd.DataFrame({"run": later, "anchor": anchor, "mark": mark, "doc": doc, "row": row, "pos": pos.astype("int32"), "windows": windows.astype("int32")})
    return out if data is None else out.assign(bytes=[None if gone else data[i] for i, gone in zip(order.tolist(), later.tolist(), strict=True)])


def _find(batches):
    """Per batch: the first of equal snippets, and runs of windows for the others, which go."""
    for b in batches:
        out = []
        doc, row = b["doc"].to_numpy(), b["row"].to_numpy()
        for number, start, raw, bounds in _chunks(b["text"].tolist()):
            if found := _snippets(raw, bounds):
                which, pos, windows, _, anchor, mark = found
                out.append((anchor, mark, doc[number[which]], row[number[which]], pos + start[which], windows))
        if out:
            yield _deduped(*(np.concatenate(x) for x in zip(*out, strict=True)))


def _recut(size: int):
    """Snippets with their bytes, cut finer by anchors of ``size`` bytes; as ``_find``, with their bytes."""

    def run(batches):
        for b in batches:
            for lo in range(0, len(b), 4096):
                part = b.iloc[lo : lo + 4096]
                held = part["bytes"].tolist()
                raw, bounds = np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)])
                which, start, windows, _, anchor, mark = _snippets(raw, bounds, size)
                before, doc, row, pos = (part[c].to_numpy()[which] for c in ("anchor", "doc", "row", "pos"))
                both = _mix(before.view(_U) * _U(_BASE) + anchor.view(_U)).view(np.int64)
                data = [held[i][s : s + n - 1 + WIDTH] for i, s, n in zip(which.tolist(), start.tolist(), windows.tolist(), strict=True)]
                yield _deduped(both, mark, doc, row, pos + start, windows, data)

    return run


def _meet(batches):
    """Rows in the order of (anchor, mark, doc, pos): the first of equal snippets where the anchor has
    others or is ``hot``, that is, has others elsewhere, and runs for the rest."""
    last, waits = None, None  # the present snippet's first row; whether it was sent on

    for b in batches:
        if not len(b):
            continue
        rows = b if last is None else pd.concat([last, b], ignore_index=True)
        anchor, mark, d, pos = (rows[c].to_numpy() for c in ("anchor", "mark", "doc", "pos"))
        near = anchor[1:] == anchor[:-1]
        new = np.concatenate([[True], ~near | (mark[1:] != mark[:-1])])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = ~new & ((d != d[lead]) | (pos != pos[lead]))
        heads = np.flatnonzero(new)
        alike = anchor[heads[1:]] == anchor[heads[:-1]]
        sent = np.concatenate([[False], alike]) | np.concatenate([alike, [False]]) | rows["hot"].to_numpy()[heads]
        if last is not None:
            sent[0] = sent[0] and not waits
            shared_first = waits
        else:
            shared_first = False
        # rows equal to the first in place as well are the same document's repeated row
        same = ~new & ~later
        keep = np.zeros(len(rows), dtype=bool)
        keep[heads[:-1]] = sent[:-1]
        tail_sent = bool(sent[-1]) or (len(heads) == 1 and shared_first)
        keep[heads[-1]] = bool(sent[-1])
        body = rows[(keep | later) & ~same].assign(run=later[(keep | later) & ~same])
        last, waits = rows.iloc[[heads[-1]]], tail_sent
        if len(body):
            yield body.drop(columns="hot")


def _fetch(batches):
    for b in batches:
        out = []
        for doc, row, text, wants in zip(b["doc"], b["row"], b["text"], b["wants"], strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            for w in wants:
                out.append((w["anchor"], w["many"], doc, row, w["pos"], w["windows"], data[w["pos"] : w["pos"] + w["windows"] - 1 + WIDTH]))
        if out:
            yield pd.DataFrame(out, columns=["anchor", "many", "doc", "row", "pos", "windows", "bytes"])


def _codes(shards: list[np.ndarray]) -> np.ndarray:
    """For each place of the shards, end to end, the rank of the STEP bytes from there on."""
    wide = []
    for raw in shards:
        one = np.zeros(len(raw), dtype=_U)
        for i in range(STEP):
            one = one << _U(8) | np.roll(raw, -i).astype(_U)
        wide.append(one)
    return np.unique(np.concatenate(wide), return_inverse=True)[1]


def _keys(codes: np.ndarray) -> list[np.ndarray]:
    """The codes as one or two arrays of 16 bits, the lower ones first, for a radix sort."""
    low = (codes & 0xFFFF).astype(np.uint16)
    return [low] if codes.max(initial=0) < 1 << 16 else [low, (codes >> 16).astype(np.uint16)]


def _stable(keys: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    order = np.argsort(keys[0][at], kind="stable")
    for more in keys[1:]:
        order = order[np.argsort(more[at[order]], kind="stable")]
    return order


def suffix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Places of a circular text in the order of at least WIDTH bytes from there on."""
    n = len(keys[0])
    order = np.arange(n)
    for back in reversed(range(0, WIDTH, STEP)):
        order = order[_stable(keys, (order + back) % n)]
    return order


def merge(shards: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(places, codes): places of all shards' texts, laid end to end, in the order of at least WIDTH bytes
    from there on (round the end of their shard), by interleaving the shards' transforms; and the codes of
    the bytes at each place."""
    starts = np.cumsum([0, *(len(s) for s in shards)])
    codes = _codes(shards)
    keys = _keys(codes)
    place, first, before = (np.empty(len(codes), np.int64) for _ in range(3))
    for s, at in zip(shards, starts[:-1], strict=True):
        n = len(s)
        order = suffix_order([k[at : at + n] for k in keys])
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        back = (order - STEP) % n
        place[at : at + n] = at + order
        first[at : at + n] = at + rank[back]  # last-to-first map, STEP bytes at once
        before[at : at + n] = codes[at + back]  # the transform
    keys = _keys(before)
    inter = np.arange(len(codes))
    for _ in range(0, WIDTH, STEP):
        inter = first[inter[_stable(keys, inter)]]
    return place[inter], codes


def repeats(parts: list[bytes], windows: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """For every window of every part, in order, whether an equal one starts earlier."""
    lengths = np.array([len(p) for p in parts])
    cuts = np.searchsorted(np.cumsum(lengths), lengths.sum() * np.arange(1, SHARDS) / SHARDS)
    groups = [g for g in np.split(np.arange(len(parts)), np.unique(cuts)) if len(g)]
    raw = [np.frombuffer(b"".join(parts[i] for i in g), np.uint8) for g in groups]
    order, codes = merge(raw)
    begin = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(parts)), lengths)
    offset = np.arange(len(codes)) - begin[owner]
    is_window = offset < windows[owner]
    order = order[is_window[order]]
    # common prefixes of neighbours, as far as WIDTH
    left = np.arange(len(order) - 1)
    for i in [*range(0, WIDTH - STEP, STEP), WIDTH - STEP]:
        left = left[codes[order[left] + i] == codes[order[left + 1] + i]]
    same = np.zeros(len(order), dtype=bool)
    same[left + 1] = True
    interval = np.cumsum(~same) - 1
    many = np.flatnonzero(np.bincount(interval, minlength=1)[interval] > 1) if len(order) else np.zeros(0, np.int64)
    at, interval = order[many], interval[many]
    d, p = doc[owner[at]], pos[owner[at]] + offset[at]
    by = np.lexsort((p, d, interval))
    at, interval, d, p = at[by], interval[by], d[by], p[by]
    head = np.concatenate([[True], interval[1:] != interval[:-1]]) if len(at) else np.zeros(0, bool)
    lead = np.flatnonzero(head)[np.cumsum(head) - 1] if len(at) else np.zeros(0, np.int64)
    gone = np.zeros(len(codes), dtype=bool)
    gone[at[(d != d[lead]) | (p != p[lead])]] = True
    return gone[is_window]


def _runs(gone: np.ndarray, windows: np.ndarray, doc: np.ndarray, row: np.ndarray, pos: np.ndarray) -> pd.DataFrame:
    begin = np.cumsum(windows) - windows
    owner = np.repeat(np.arange(len(windows)), windows)
    edge = gone.copy()
    edge[1:] &= ~gone[:-1] | (owner[1:] != owner[:-1])
    start = np.flatnonzero(edge)
    end = np.flatnonzero(gone & np.concatenate([~gone[1:] | (owner[1:] != owner[:-1]), [True]])) + 1
    o = owner[start]
    return pd.DataFrame({"doc": doc[o], "row": row[o], "pos": (pos[o] + start - begin[o]).astype("int32"), "windows": (end - start).astype("int32")})


def _solve(batches):
    """Snippets in the order of their anchors, whole anchors at a time."""
    rest = None

    def solved(b):
        windows, doc, row, pos = (b[c].to_numpy() for c in ("windows", "doc", "row", "pos"))
        return _runs(repeats(b["bytes"].tolist(), windows, doc, pos), windows, doc, row, pos)

    for b in batches:
        rest = b if rest is None else pd.concat([rest, b], ignore_index=True)
        upto, anchor = np.cumsum(rest["bytes"].str.len().to_numpy()), rest["anchor"].to_numpy()
        ends = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        at = 0
        while len(ends := ends[ends > at]) and upto[-1] - (upto[at - 1] if at else 0) >= BATCH:
            fit = ends[upto[ends - 1] - (upto[at - 1] if at else 0) <= BATCH]
            cut = int(fit[-1]) if len(fit) else int(ends[0])
            yield solved(rest.iloc[at:cut])
            at = cut
        rest = rest.iloc[at:]
    if rest is not None and len(rest):
        yield solved(rest)


def _cut(batches):
    for b in batches:
        rows = []
        for doc, text, runs in zip(b["doc"], b["text"], b["runs"], strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            step = np.zeros(len(data) + 1, dtype=np.int32)
            if runs is not None and len(runs):
                start = np.array([r["pos"] for r in runs])
                np.add.at(step, start, 1)
                np.add.at(step, start + np.array([r["windows"] for r in runs]) - 1 + WIDTH, -1)
            gone = np.cumsum(step[:-1]) > 0
            spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if spans else data
            rows.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        yield pd.DataFrame(rows, columns=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _sorted_by_mark(fresh: DataFrame) -> DataFrame:
    """Dealt out by anchor, those with much of a task's share by their marks as well, and sorted for ``_meet``.

    A sample of the rows tells which these are; it moves work between tasks and changes no result. There are
    fewer than tasks / ``SHARE`` of them but for the sample's error, so they are broadcast."""
    n = fresh.count()
    tasks = tasks_for(fresh.sparkSession, 48 * n)
    count = F.count("*") * EVERY
    heavy = fresh.where(F.pmod(F.xxhash64("doc", "pos"), F.lit(EVERY)) == 0).groupBy("anchor").agg(count.alias("n")).where(F.col("n") > max(HEAVY, int(SHARE * n / tasks)))
    dealt = fresh.join(F.broadcast(heavy.select("anchor", F.lit(True).alias("hot"))), "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    salt = F.when(F.col("hot"), F.pmod("mark", F.lit(tasks))).otherwise(0)
    return dealt.withColumn("salt", salt).repartition(tasks, "anchor", "salt").drop("salt").sortWithinPartitions("anchor", "mark", "doc", "pos")


def _sized(snippets: DataFrame) -> DataFrame:
    """With m, the number of the anchor's snippets, where that is more than one."""
    sizes = written(snippets.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1"))
    return snippets.join(F.broadcast(sizes) if sizes.count() <= BROADCAST_ANCHORS else sizes, "anchor")


def _merged(snippets: DataFrame) -> DataFrame:
    """Runs (doc, row, pos, windows) that the merge of each anchor's transforms finds."""
    dealt = snippets.select("anchor", "doc", "row", "pos", "windows", "bytes")
    tasks = tasks_for(snippets.sparkSession, snippets.count() * 2 * WIDTH, 16 << 20)
    return dealt.repartition(tasks, "anchor").sortWithinPartitions("anchor").mapInPandas(_solve, _RUNS)


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal runs of removed
    bytes), kept_sha256 and kept (the bytes that are left; they may split a character).

    Texts are UTF-8 bytes, null texts are empty; windows never cross documents. Earlier means a smaller
    doc_id, or an earlier start in the same document; strings are judged on the input. Null ids come
    first. Rows that share an id are one document: equal starts in them do not make each other go. An
    empty table gives no rows; other columns are ignored.
    """
    held = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(LONG_MIN)).alias("doc"), F.col(text).alias("text"))
    n, ids = held.select("doc").agg(F.count("*"), F.count_distinct("doc")).first()
    # only ids that repeat need the text to tell their rows apart
    rows = held.withColumn("row", F.xxhash64("text") if n > ids else F.lit(0).cast("long")).select("doc", "row", "text")
    found = written(rows.mapInPandas(_find, _FOUND))
    met = written(_sorted_by_mark(found.where("not run")).mapInPandas(_meet, _FOUND))
    wanted = met.where("not run").select("anchor", "doc", "row", "pos", "windows")
    large = written(wanted.groupBy("anchor").agg(F.count("*").alias("m")).where(F.col("m") > MOST).select("anchor", F.lit(True).alias("many")))
    many = large.count()
    wanted = wanted.join(F.broadcast(large) if many <= BROADCAST_ANCHORS else large, "anchor", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    wants = wanted.groupBy("doc", "row").agg(F.collect_list(F.struct("anchor", "many", "pos", "windows")).alias("wants"))
    snippets = map_small(rows.join(wants, ["doc", "row"]), _fetch, "anchor long, many boolean, doc long, row long, pos int, windows int, bytes binary")
    snippets = written(snippets)
    runs = [found.where("run"), met.where("run"), _merged(snippets.where("not many"))]
    left = snippets.where("many")
    for size in FINER if many else ():
        cut = written(left.mapInPandas(_recut(size), f"{_FOUND}, bytes binary"))
        fresh = cut.where("not run").withColumn("hot", F.lit(True))
        dealt = fresh.repartition(tasks_for(docs.sparkSession, fresh.count() * 2 * WIDTH, 16 << 20), "anchor", "mark").sortWithinPartitions("anchor", "mark", "doc", "pos")
        met = written(dealt.mapInPandas(_meet, f"{_FOUND}, bytes binary"))
        sized = written(_sized(met.where("not run")))
        runs += [cut.where("run"), met.where("run"), _merged(sized.where(F.col("m") <= MOST))]
        left = sized.where(F.col("m") > MOST)
        if not left.limit(1).count():
            break
    else:
        if many:  # equal grams of whole windows with other marks: a collision, which the merge settles
            runs.append(_merged(left))
    gone = None
    for r in runs:
        r = r.select("doc", "row", "pos", "windows")
        gone = r if gone is None else gone.unionByName(r)
    per = gone.groupBy("doc", "row").agg(F.collect_list(F.struct("pos", "windows")).alias("runs"))
    cut = rows.join(per, ["doc", "row"], "left").select("doc", "text", "runs")
    cut = map_small(cut, _cut, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return cut.withColumn("doc_id", F.when(F.col("doc") != F.lit(LONG_MIN), F.col("doc"))).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
