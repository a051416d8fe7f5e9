"""Order-preserving packing: window cuts by dynamic programming.

Documents are taken in the order of their ids as one stream of tokens. A window is a run of at
most ``size`` tokens. Cuts may lie where a document ends (free), where a sentence ends (a
penalty for the truncated document) or, where sentences are long, every ``STRIDE`` tokens (a larger
penalty). The cuts minimise padding plus penalties. With pos the place of a cut and f its cost,

    f(j) = penalty(j) + size - pos(j) + min { f(i) + pos(i) : pos(j) - pos(i) <= size },

so the transition is a sliding minimum over cuts, kept in a monotone queue: linear time.

The stream is cut into runs of about ``RUN`` bytes of text (more where they would be over ``MOST_RUNS``), by sums over
the whole table, and each run is packed on its own, in buffers of bounded size, whatever the length of a
document; only its last window is left short. So the same rows give the same pieces however the table is
stored and on however many machines.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm import tokens
from attesta.llm.runtime import LONG_MIN, map_small, ranked

SIZE = 2_048
STRIDE = 64
SENTENCE, MIDDLE = 16.0, 48.0
#: Tokens of a buffer.
BUFFER = 1 << 20
#: Bytes of text of a run, and runs at most: the driver gets the first key of each.
RUN, MOST_RUNS = 12_000_000, 20_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cuts(pos: list[int], penalty: list[float], size: int) -> list[int]:
    """Places in ``pos`` (rising, from 0 to the stream's end, gaps at most ``size``) of the cheapest
    cuts, its first and last among them."""
    n = len(pos)
    cost, came = [0.0] * n, [0] * n
    queue: deque[int] = deque([0])
    key = [0.0] * n
    for j in range(1, n):
        at = pos[j]
        while pos[queue[0]] < at - size:
            queue.popleft()
        i = queue[0]
        came[j] = i
        cost[j] = key[i] + penalty[j] + size - at
        key[j] = k = cost[j] + at
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    out = [n - 1]
    while out[-1]:
        out.append(came[out[-1]])
    return out[::-1]


class _Stream:
    """Documents in, pieces of finished windows out."""

    def __init__(self, size: int, part: int, crc: bool = True):
        self.size, self.part, self.crc, self.windows = size, part, crc, 0
        self.docs: list[tuple] = []  # (id, start in its document, ids, all its tokens)
        self.pos: list[int] = [0]
        self.penalty: list[float] = [0.0]
        self.held = 0

    def add(self, doc, ids: np.ndarray, ends: np.ndarray):
        total = len(ids)
        for lo in range(0, total, BUFFER):
            hi = min(total, lo + BUFFER)
            inner = ends[np.searchsorted(ends, lo, "right") : np.searchsorted(ends, hi, "left")] - lo
            self._cut(inner.tolist(), hi - lo, hi == total)
            self.docs.append((doc, lo, ids[lo:hi], total))
            if self.held >= BUFFER:
                yield from self.flush(False)

    def _cut(self, inner: list[int], length: int, whole: bool) -> None:
        base, last, stride = self.held, 0, min(STRIDE, self.size)
        for at in [*inner, length]:
            for middle in range(last + stride, at, stride):
                self.pos.append(base + middle)
                self.penalty.append(MIDDLE)
            if at > last:
                self.pos.append(base + at)
                self.penalty.append(SENTENCE if at < length else 0.0 if whole else MIDDLE)
            last = at
        self.held += length

    def flush(self, end: bool):
        if not self.held:
            return
        chosen = cuts(self.pos, self.penalty, self.size)
        if not end:
            chosen = chosen[: max(2, len(chosen) * 3 // 4)]  # the last cuts may yet move
        edges = np.array([self.pos[c] for c in chosen])
        lengths = np.array([len(d[2]) for d in self.docs])
        ends = np.cumsum(lengths)
        bounds = np.union1d(edges, ends[ends < edges[-1]])
        lo, hi = bounds[:-1], bounds[1:]
        which = np.searchsorted(ends, lo, "right")
        window = np.searchsorted(edges, lo, "right") - 1
        rows = []
        for a, b, d, w in zip(lo.tolist(), hi.tolist(), which.tolist(), window.tolist(), strict=True):
            doc, first, ids, total = self.docs[d]
            begin = a - int(ends[d] - lengths[d])
            crc = zlib.crc32(ids[begin : begin + b - a].astype("<u4").tobytes()) if self.crc else 0
            rows.append((doc, first + begin, b - a, crc, total, (self.part << 40) + self.windows + w, a - int(edges[w])))
        self.windows += len(edges) - 1
        yield rows
        keep, at = chosen[-1], int(edges[-1])
        if end or at == self.held:
            self.docs, self.pos, self.penalty, self.held = [], [0], [0.0], 0
            return
        self.pos = [p - at for p in self.pos[keep:]]
        self.penalty = self.penalty[keep:]
        d = int(np.searchsorted(ends, at, "right"))
        doc, first, ids, total = self.docs[d]
        skip = at - int(ends[d] - lengths[d])
        self.docs = [(doc, first + skip, ids[skip:], total), *self.docs[d + 1 :]]
        self.held -= at


def _at_or_before(edges: Column, n: int, key: Column) -> Column:
    """The place from 0 of the last of ``n`` rising ``edges`` that is at most ``key``, by halving; the first is."""
    middle = lambda a: F.shiftright(a["lo"] + a["hi"] + 1, 1)
    step = lambda a, _: F.when(F.get(edges, middle(a)) <= key, F.struct(middle(a).alias("lo"), a["hi"].alias("hi"))).otherwise(F.struct(a["lo"].alias("lo"), F.greatest(a["lo"], middle(a) - 1).alias("hi")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, n.bit_length()))), F.struct(F.lit(0).alias("lo"), F.lit(n - 1).alias("hi")), step, lambda a: a["lo"])


def runs(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(run, id, text), in one partition for each run and in the order of ids, of which a null is the least, and of a hash
    of the texts within an id. Null texts are empty. Rows equal in both are dealt out by their place in the table, so that
    they may be many runs; which of them is in which makes no difference."""
    rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(LONG_MIN)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    sized = ranked(rows.select("id", "tie", "row", (F.octet_length("text") + 1).cast("long").alias("n")), ["id", "tie", "row"], "before", weight="n")
    total = sized.agg(F.sum("n")).first()[0] or 0
    each = max(RUN, -(-total // MOST_RUNS))
    first = sized.groupBy(F.floor(F.col("before") / each).alias("run")).agg(F.min(F.struct("id", "tie", "row")).alias("k")).select("k.*").collect()
    keys = sorted(tuple(r) for r in first) or [(LONG_MIN, 0, 0)]
    edges = F.from_json(F.lit("[" + ",".join(f'{{"id":{a},"tie":{b},"row":{c}}}' for a, b, c in keys) + "]"), "array<struct<id:bigint,tie:bigint,row:bigint>>")
    placed = rows.withColumn("run", _at_or_before(edges, len(keys), F.struct("id", "tie", "row")))
    return placed.repartitionById(len(keys), "run").sortWithinPartitions("run", "id", "tie", "row").select("run", "id", "text")


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row for each piece of a document in a sequence: doc_id, start (ids of its document before
    it), length, ids_crc32 (of its ids as little-endian 32-bit integers), doc_tokens (with the end id),
    sequence_id and offset (place in the sequence, gapless from 0).

    A document is the ids of its text and the end id; a null or empty text is the end id alone. Every
    id lies in exactly one piece. Null ids come first; rows with one id are packed one after another,
    ties in the order of a hash of their texts. An empty table gives no rows; other columns are ignored.
    """
    path = tokenizer or tokens.path_of()

    def run(batches):
        tok, stream = tokens.tokenizer(path), None

        def frame(rows):
            return pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")]).astype({"doc_id": "Int64"})

        for b in batches:
            for part, doc, (ids, ends) in zip(b["run"].to_pylist(), b["id"].to_pylist(), tok.many(b["text"]), strict=True):
                if stream is None or part != stream.part:  # another run begins
                    for rows in stream.flush(True) if stream else ():
                        yield frame(rows)
                    stream = _Stream(size, part)
                for rows in stream.add(None if doc == LONG_MIN else doc, np.append(ids, ids.dtype.type(tokens.END)), ends):
                    yield frame(rows)
        for rows in stream.flush(True) if stream else ():
            yield frame(rows)

    return map_small(runs(docs, id, text), run, PIECES, arrow=True)
