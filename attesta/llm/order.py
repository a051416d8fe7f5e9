"""Training-order materialisation: a keyed permutation gives every sequence its global slot.

All texts, in the order of their ids, are one stream of token ids, cut into sequences of fixed length that
are numbered from 0. Tasks tokenize their own stretches of it; the sums of these say where each
stretch begins, so the numbering does not depend on how the table is split. A balanced Feistel network, keyed by the seed, permutes
the next power of four; numbers that fall outside are sent through it again until they fall inside
(cycle-walking), which leaves a permutation of exactly the sequences. So a slot is computed, not
drawn: nothing is sorted or remembered to shuffle the corpus, any epoch is another key, and the
inverse says which sequence a slot holds.

Shards are ranges of ``stride`` slots, and partitions are these ranges: each is written by one task as
one file, in the order of slots, every record of the same number of bytes, so a reader that has come to
slot s goes on in shard s // stride, at record s % stride.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import tokens
from attesta.llm.runtime import LONG_MIN, drop, in_order, map_small, shared_dir, written

#: Ids of a sequence, sequences of a shard (128 MiB of ids of 2 bytes), rounds of the network.
LENGTH, STRIDE, ROUNDS = 2_048, 32_768, 4

_U = np.uint64


class Feistel:
    """A permutation of 0 to n - 1, keyed by ``seed``; ``inverse`` undoes it."""

    def __init__(self, n: int, seed: int):
        self.n, self.half = n, max(1, (max(1, n - 1).bit_length() + 1) // 2)
        self.mask = _U((1 << self.half) - 1)
        self.keys = np.random.default_rng(seed).integers(0, 2**63, ROUNDS, dtype=_U)

    def _f(self, x: np.ndarray, key) -> np.ndarray:
        x = (x ^ key) * _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        return (x ^ (x >> _U(32))) & self.mask

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> _U(self.half), x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._f(right, key)
        return (left << _U(self.half)) | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> _U(self.half), x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ self._f(left, key), left
        return (left << _U(self.half)) | right

    def _walk(self, step, x) -> np.ndarray:
        out = step(np.asarray(x).astype(_U))
        while (far := out >= _U(self.n)).any():
            out[far] = step(out[far])
        return out.astype(np.int64)

    def slots(self, x) -> np.ndarray:
        return self._walk(self._once, x)

    def inverse(self, x) -> np.ndarray:
        return self._walk(self._back, x)


_CUT = "part int, run int, place long, n_tokens int, tokens binary, docs array<struct<at: int, doc: long, start: long>>"


def _rows(ids: np.ndarray, begins: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int, part: int, run: int, place: int) -> list[pa.Array]:
    """Columns of the rows of ``length`` ids that ``ids`` is cut into, the last perhaps shorter. begins, doc
    and start: where in ``ids`` documents begin, and how many of their own ids come before."""
    n = -(-len(ids) // length)
    edges = np.minimum(np.arange(n + 1) * length, len(ids))
    at = np.union1d(begins, edges[:-1])
    which = np.searchsorted(begins, at, "right") - 1
    head = pa.StructArray.from_arrays(
        [pa.array((at % length).astype(np.int32)), pa.array(doc[which]), pa.array(start[which] + at - begins[which])], ["at", "doc", "start"]
    )
    ids = np.ascontiguousarray(ids, dtype=np.dtype(ids.dtype).newbyteorder("<"))
    width = ids.dtype.itemsize
    return [
        pa.array(np.full(n, part, np.int32)),
        pa.array(np.full(n, run, np.int32)),
        pa.array(place + edges[:-1]),
        pa.array(np.diff(edges).astype(np.int32)),
        pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((edges * width).astype(np.int32)), pa.py_buffer(ids)]),
        pa.ListArray.from_arrays(np.searchsorted(at, edges).astype(np.int32), head),
    ]


def stream(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents' ids, each document closed by the end id, in rows of up to ``length`` ids.

    Each run (part, run) is a stretch of documents in the order of their ids; place is the number of
    its ids before the row. docs says where in the row documents begin or go on: at, the document's id,
    and how many of its own ids come before. tokens holds little-endian ids of 2 bytes, or 4 for large
    vocabularies.
    """
    path = tokenizer or tokens.path_of()

    def cut(batches):
        from pyspark import TaskContext

        tok, part, run, place, last = tokens.tokenizer(path), TaskContext.get().partitionId(), 0, 0, LONG_MIN
        held: list[np.ndarray] = []
        doc: list[int] = []
        start: list[int] = []
        size = 0

        def rows(end: bool):
            nonlocal held, doc, start, size, place
            ids = np.concatenate(held)
            begins = np.cumsum([0, *(len(h) for h in held[:-1])])
            upto = len(ids) if end else len(ids) // length * length
            within = np.searchsorted(begins, upto)
            out = _rows(ids[:upto], begins[:within], np.array(doc[:within]), np.array(start[:within]), length, part, run, place)
            place, size = place + upto, len(ids) - upto
            first = int(np.searchsorted(begins, upto, "right")) - 1
            gone = upto - int(begins[first])
            held, doc, start = ([ids[upto:]] if len(held) == first + 1 else [ids[upto : begins[first + 1]], *held[first + 1 :]], doc[first:], start[first:]) if size else ([], [], [])
            if size:
                start[0] += gone
            return out

        for b in batches:
            for d, (ids, _) in zip(b["id"].to_pylist(), tok.many(b["text"]), strict=True):
                if d < last:  # another run begins
                    if size:
                        yield rows(True)
                    run, place = run + 1, 0
                last = d
                held.append(np.append(ids, ids.dtype.type(tokens.END)))
                doc.append(d)
                start.append(0)
                size += len(held[-1])
                if size >= 256 * length:
                    yield rows(False)
        if size:
            yield rows(True)

    return map_small(in_order(docs, id, text), cut, _CUT, arrow=True)


def _assembled(length: int, width: int):
    """Pieces in the order of (slot, at) -> whole sequences, the last filled up with end ids."""
    fill = tokens.END.to_bytes(width, "little")

    def run(batches):
        head, parts = None, []

        def whole():
            data = b"".join(parts)
            return (*head, len(data) // width, data + fill * (length - len(data) // width))

        for b in batches:
            out = []
            for shard, slot, sequence, doc, start, data in zip(*(b.column(c).to_pylist() for c in ("shard", "slot", "sequence", "doc_id", "start", "tokens")), strict=True):
                if head is not None and head[1] == slot:
                    parts.append(data)
                    continue
                if head is not None:
                    out.append(whole())
                head, parts = (shard, slot, sequence, doc, start), [data]
            if out:
                yield [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _KINDS, strict=True)]
        if head is not None:
            yield [pa.array([c], t) for c, t in zip(whole(), _KINDS, strict=True)]

    return run


_SHARDS = "shard int, slot long, sequence long, doc_id long, start long, n_tokens int, tokens binary"
_KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]


def materialise(docs: DataFrame, path: str | None = None, seed: int = 17, length: int = LENGTH, stride: int = STRIDE, tokenizer: str | None = None) -> str:
    """Writes the shards of ``docs`` in training order and returns their folder: Parquet, a folder
    shard=k of one file for each range of ``stride`` slots, rows (slot, sequence, doc_id, start,
    n_tokens, tokens) in the order of slots. Without ``path`` a new folder in the shared one.

    All documents in the order of their ids are one stream, cut into sequences of ``length`` ids, of which
    only the last is filled up with end ids; doc_id and start say where a sequence's first id comes from.
    Null texts count as empty (the end id alone), null ids come first and stay null, rows of one id follow
    one another in the order of a hash of their texts, other columns are ignored; an empty table writes an
    empty folder. The same rows and seed give the same shards, however the table is stored and split.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    cut = written(stream(docs, tokenizer, length), "zstd")
    # one row for each run; by the ids of their first documents they follow one another
    runs = cut.groupBy("part", "run").agg(F.min(F.col("docs")[0]["doc"]).alias("first"), F.sum("n_tokens").alias("n"), F.max(F.octet_length("tokens") / F.col("n_tokens")).alias("width"))
    runs = runs.toPandas().sort_values(["first", "part"])
    total = int(runs["n"].sum())
    if not total:
        spark.createDataFrame([], _SHARDS).write.parquet(path)
        return path
    n, width = -(-total // length), int(runs["width"].max())
    runs["before"] = runs["n"].cumsum() - runs["n"]
    before = F.broadcast(spark.createDataFrame(runs[["part", "run", "before"]].astype("int64")))  # a few numbers for each task
    network = Feistel(n, seed)

    @F.pandas_udf("long")
    def slot(numbers: pd.Series) -> pd.Series:
        return pd.Series(network.slots(numbers.to_numpy()))

    # a row reaches over the edge of a sequence into the next one, or not
    place = F.col("place") + F.col("before")
    rows = cut.join(before, ["part", "run"]).select("n_tokens", "tokens", "docs", F.floor(place / length).alias("sequence"), (place % length).cast("int").alias("at"))
    over = F.lit(length) - F.col("at")

    def piece(sequence, at, lo, n_bytes):
        head = F.element_at(F.filter("docs", lambda d: d["at"] <= lo), -1)
        data = F.substring("tokens", lo * width + 1, n_bytes)
        return F.struct(sequence.cast("long").alias("sequence"), at.cast("int").alias("at"), head["doc"].alias("doc"), (head["start"] + lo - head["at"]).alias("start"), data.alias("tokens"))

    one = piece(F.col("sequence"), F.col("at"), F.lit(0), F.least(over, F.col("n_tokens")) * width)
    two = piece(F.col("sequence") + 1, F.lit(0), over, (F.col("n_tokens") - over) * width)
    pieces = rows.select(F.explode(F.when(F.col("n_tokens") > over, F.array(one, two)).otherwise(F.array(one))).alias("p")).select("p.*")
    pieces = pieces.withColumn("slot", slot("sequence")).withColumn("shard", F.floor(F.col("slot") / stride).cast("int"))
    doc = F.when(F.col("doc") != LONG_MIN, F.col("doc"))
    dealt = pieces.select("shard", "slot", "at", "sequence", doc.alias("doc_id"), "start", "tokens")
    # a range of slots is a partition, whose number is the shard's
    dealt = dealt.repartitionById(-(-n // stride), "shard").sortWithinPartitions("shard", "slot", "at")
    whole = map_small(dealt, _assembled(length, width), _SHARDS, rows=1024, arrow=True)
    whole.sortWithinPartitions("shard", "slot").write.option("compression", "zstd").partitionBy("shard").parquet(path)
    drop(cut)
    return path


def resume(spark: SparkSession, path: str, slot: int = 0, stride: int = STRIDE) -> DataFrame:
    """The sequences from ``slot`` on: earlier shards are not opened."""
    schema = "slot long, sequence long, doc_id long, start long, n_tokens int, tokens binary, shard int"
    return spark.read.schema(schema).parquet(path).where((F.col("shard") >= slot // stride) & (F.col("slot") >= slot))


def digest(shards: DataFrame, stride: int = STRIDE) -> DataFrame:
    """What the shards hold, without the ids: with the place in the shard and the ids' CRC-32."""

    @F.pandas_udf("long")
    def crc(records: pd.Series) -> pd.Series:
        return pd.Series([zlib.crc32(r) for r in records], dtype="int64")

    return shards.select("slot", "shard", (F.col("slot") % stride).cast("int").alias("record"), "sequence", "doc_id", "start", "n_tokens", crc("tokens").alias("tokens_crc32"))
