"""Many needles in many texts: a table of bits of the needles' hashes, and the runs of bytes that it lets through.

The hash of a run is a sum of numbers for its bytes times powers of an odd number, so that of any run follows from the
sums up to its two ends. Needles are looked for by their first bytes, then by twice as many, and as a whole by each length that
needles have; so what starts like no needle costs one look, however many lengths there are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Bits of the table for each needle, and the least and most of the table: 128 KiB and 32 MiB. Bits that are set for a hash.
BITS, LEAST_BITS, MOST_BITS, SET = 32, 2**20, 2**28, 3
#: Bytes of text that are searched, and of runs that are returned, at once.
SPAN, OUT = 2**18, 2**22
#: Bits of a piece of the table.
PIECE = 2**16

_ODD = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(7).integers(1, 2**64, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64)] * 2


def _powers_to(n: int) -> list[np.ndarray]:
    """Powers of _ODD and of its inverse, modulo 2^64."""
    if len(_powers[0]) <= n:
        size = max(n, SPAN)
        _powers[:] = [np.cumprod(np.append(np.uint64(1), np.full(size, x, np.uint64))) for x in (_ODD, pow(_ODD, -1, 2**64))]
    return _powers


class _Sums:
    """Hashes of the runs of some bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers_to(len(data))
        self.to = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.to[1:])

    def everywhere(self, n: int) -> np.ndarray:
        """Of the runs of n bytes from each place on."""
        count = max(len(self.to) - n, 0)
        return (self.to[n : n + count] - self.to[:count]) * self.down[:count]

    def at(self, start: np.ndarray, n: int | np.ndarray) -> np.ndarray:
        return (self.to[start + n] - self.to[start]) * self.down[start]


def _levels(lengths: list[int], gram: int) -> list[int]:
    """The lengths of first bytes that are looked at: ``gram`` doubled, from as many on as all needles of ``gram`` bytes have."""
    long = [n for n in lengths if n >= gram]
    out = [gram << i for i in range(64) if long and gram << i <= long[-1]]
    return [g for g in out if 2 * g > long[0]]


def _slots(hashes: np.ndarray, n: int, whole: bool, i: int, bits: int) -> np.ndarray:
    """The i-th bit of each hash of a run of n bytes."""
    mixed = (hashes ^ np.uint64((2 * (SET * n + i) + whole) * 0xD6E8FEB86659FD93 % 2**64)) * np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xC4CEB9FE1A85EC53)
    return (mixed >> np.uint64(65 - bits.bit_length())).astype(np.int64)


def _held(table: np.ndarray, hashes: np.ndarray, n: int, whole: bool) -> np.ndarray:
    """Places of the hashes whose bits are all set."""
    spots = None
    for i in range(SET):
        own = hashes if spots is None else hashes[spots]
        at = _slots(own, n, whole, i, 8 * len(table))
        on = np.flatnonzero((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
        spots = on if spots is None else spots[on]
    return spots


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, and where each text starts and the last one ends; a null has none."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8), ends


def _spans(ends: np.ndarray, longest: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row after the last, first byte, byte after the last) of some bytes at once: of whole texts, or of a
    longer text in pieces that overlap, so that each run of up to ``longest`` bytes is in one."""
    most, row = max(SPAN, 2 * longest), 0
    while row < len(ends) - 1:
        to = max(row + 1, int(np.searchsorted(ends, ends[row] + most, "right")) - 1)
        start, stop = int(ends[row]), int(ends[to])
        while stop - start > most:
            yield row, to, start, start + most
            start += most - longest + 1
        yield row, to, start, stop
        row = to


def table(needles: DataFrame, needle: str, count: int, lengths: list[int], gram: int) -> np.ndarray:
    """The bits of the hashes of all ``count`` needles and of their first bytes, made by tasks; the driver puts pieces of a fixed size together."""
    levels = _levels(lengths, gram)
    bits = min(max(1 << (BITS * count).bit_length(), LEAST_BITS), MOST_BITS)

    def marks(batches):
        for batch in batches:
            data, ends = _bytes(batch.column(0))
            for row, to, start, stop in _spans(ends, lengths[-1]):
                sums = _Sums(data[start:stop])
                at, size = ends[row:to] - start, np.diff(ends[row : to + 1])
                own = [(sums.at(at[size == n], n), int(n), True) for n in np.unique(size) if n]
                own += [(sums.at(at[size >= g], g), g, False) for g in levels]
                slots = np.unique(np.concatenate([np.empty(0, np.int64), *(_slots(*x, i, bits) for x in own for i in range(SET))]))
                yield pa.RecordBatch.from_arrays([pa.array(slots // PIECE), pa.array(slots % PIECE)], ["piece", "slot"])

    def pieces(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            piece, slot = (batch.column(i).to_numpy() for i in (0, 1))
            for p in np.unique(piece):
                held.setdefault(int(p), np.zeros(PIECE, bool))[slot[piece == p]] = True
        for p, on in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([np.packbits(on, bitorder="little").tobytes()], pa.binary())], ["piece", "bits"])

    out = np.zeros(bits // 8, np.uint8)
    dealt = needles.select(needle).mapInArrow(marks, "piece long, slot long").repartition("piece")
    for piece, own in dealt.mapInArrow(pieces, "piece long, bits binary").collect():
        out[piece * PIECE // 8 :][: PIECE // 8] = np.frombuffer(own, np.uint8)
    return out


def _runs(data: np.ndarray, ends: np.ndarray, lengths: list[int], levels: list[int], table: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, length, hash) of the runs in ``data`` that the table lets through and that lie in one text, those of a text, length and
    hash once. ends: the bytes after each text."""
    sums, out = _Sums(data), []
    within = np.append((data & 0xC0) == 0x80, False)  # bytes that a character goes on with

    def placed(start: np.ndarray) -> tuple[np.ndarray, ...]:
        text = np.searchsorted(ends, start, "right")
        return text, start, ends[text] - start

    def only(on: np.ndarray, spots: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        return tuple(x[on] for x in spots)

    def take(spots: tuple[np.ndarray, ...], n: int) -> None:
        text, start, _ = only(spots[2] >= n, spots)
        own = sums.at(start, n)
        text, start, own = only(_held(table, own, n, True), (text, start, own))
        text, start, own = only(~(within[start] | within[start + n]), (text, start, own))
        out.append((text, start, np.full(len(text), n), own))

    for n in (n for n in lengths if not levels or n < levels[0]):
        take(placed(_held(table, sums.everywhere(n), n, True)), n)
    for g in levels:
        if g == levels[0]:
            spots = placed(_held(table, sums.everywhere(g), g, False))
            spots = only(spots[2] >= g, spots)
        else:
            spots = only(spots[2] >= g, spots)
            spots = only(_held(table, sums.at(spots[1], g), g, False), spots)
        if not len(spots[0]):
            break
        for n in (n for n in lengths if g <= n < 2 * g):
            take(spots, n)
    out.append((np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),))
    held = pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["text", "start", "n", "hash"])
    held = held.group_by(["text", "n", "hash"], use_threads=False).aggregate([("start", "min")])
    return tuple(held.column(c).to_numpy() for c in ("text", "start_min", "n", "hash"))


def found(texts: DataFrame, source: str, name: str, lengths: list[int], gram: int, table: np.ndarray) -> DataFrame:
    """``texts`` without ``source``, a row for each run in ``source`` that the table lets through, as ``name``: every needle
    that the text contains, and strays. Runs of one text, length and 64-bit hash are one."""
    levels, bits = _levels(lengths, gram), texts.sparkSession.sparkContext.broadcast(table)
    others = [c for c in texts.columns if c != source]

    def run(batches):
        for batch in batches:
            rest = batch.select(others)
            data, ends = _bytes(batch.column(batch.schema.get_field_index(source)))
            before, seen = None, set()
            for row, to, start, stop in _spans(ends, lengths[-1]):
                piece = data[start:stop]
                text, at, n, own = _runs(piece, np.minimum(ends[row + 1 : to + 1] - start, stop - start), lengths, levels, bits.value)
                if stop < ends[to] or start > ends[row]:  # a piece of a text: what earlier ones had is known
                    if before != row:
                        before, seen = row, set()
                    new = np.array([(x not in seen, seen.add(x))[0] for x in zip(n.tolist(), own.tolist(), strict=True)], bool)
                    text, at, n = text[new], at[new], n[new]
                sizes, first = np.concatenate([[0], np.cumsum(n)]), 0
                while first < len(n):
                    last = max(first + 1, int(np.searchsorted(sizes, sizes[first] + OUT, "right")) - 1)
                    cut = sizes[first : last + 1] - sizes[first]
                    spots = np.arange(cut[-1]) + np.repeat(at[first:last] - cut[:-1], n[first:last])
                    words = pa.StringArray.from_buffers(last - first, pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(piece[spots]))
                    yield pa.RecordBatch.from_arrays([*rest.take(pa.array(row + text[first:last])).columns, words], [*others, name])
                    first = last

    schema = StructType([*[texts.schema[c] for c in others], StructField(name, StringType())])
    return texts.mapInArrow(run, schema)
