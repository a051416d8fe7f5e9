"""Embedding near-duplicates: randomised-rotation binary codes with stored correction factors.

Vectors are scaled to length 1 and turned by random rotations W (several one above the other, so that
|W o| = 1). The signs of W o are the code, the unit vector s = sign(W o) / sqrt(bits), and the correction
factor a = <s, W o> is stored with it. W's transpose takes a code back to x = W' s = a (o + e), where e is
at right angles to o and, over the rotation, of no preferred direction; so x / a estimates o without bias,
and |e| = sqrt(|x|² / a² - 1) is known exactly. Each vector has two codes under independent rotations. For
a pair o, q,

    <x_o, y_q> / (a b) = <o, q> + <e, q> + <o, f> + <e, f>

is an unbiased estimate of the cosine from the codes alone; at the threshold t the errors have standard
deviations of at most |e| sqrt(1 - t²), |f| sqrt(1 - t²) and |e| |f|, each over sqrt(dims - 1). Pairs whose
estimate lies more than ``CONFIDENCE`` deviations below the threshold are left out; all others are
recomputed from the vectors in double precision, and only those at or above the threshold count.

Which pairs meet is decided by the codes as well: each table takes its own bits of the first code as
the key, and pairs meet in the first table where all bits agree. A pair at the threshold keeps a
bit with chance 1 - acos(t) / pi; the number of tables follows from that, so that such a pair is
missed with a chance below ``MISS``. With more rows the keys take more bits, so the work grows
little faster than the rows. A key with more than ``BLOCK`` vectors is dealt into blocks that meet
two by two. Only codes and factors are dealt out for all tables; vectors follow for the rows, in each
block, of which an estimate is left. Tasks send on numbers of links and a spanning forest of each
block, never pairs.

Vectors with equal components are one class from the start, with a number of its own; their copies are
counted, not compared.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.runtime import components, drop, tasks_for, written
from attesta.llm.topk import usable

#: Chance to miss a pair exactly at the threshold; rows a key should hold; rows of a block, and compared at once.
MISS, KEY_ROWS, BLOCK, AT_ONCE = 1e-6, 512, 2_048, 512
#: Deviations, one-sided: 2e-7 of the pairs at the threshold. Bits of a code, at least.
CONFIDENCE, CODE_BITS = 5.1, 256
#: Keys of more than a block, of some 30 bytes each, that may be broadcast.
BROADCAST_KEYS = 500_000


class Code:
    """Signs under ``bits`` turned axes, or a few more: whole rotations."""

    def __init__(self, dims: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        turns = max(1, -(-bits // dims))
        self.axes = np.concatenate([np.linalg.qr(rng.standard_normal((dims, dims)))[0] for _ in range(turns)]) / math.sqrt(turns)
        self.bits = len(self.axes)

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(signs, factors)."""
        turned = unit @ self.axes.T
        return turned > 0, np.abs(turned).sum(1) / math.sqrt(self.bits)

    def decode(self, packed, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(signs, estimates of the vectors, lengths of their errors)."""
        signs = np.unpackbits(np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1), axis=1)[:, : self.bits]
        x = (signs * 2.0 - 1) @ self.axes / (math.sqrt(self.bits) * factor[:, None])
        return signs, x, np.sqrt(np.maximum(0, (x * x).sum(1) - 1))


class Codes:
    """The two codes of vectors of ``dims`` components; keys of ``bits`` bits for ``tables`` tables."""

    def __init__(self, dims: int, bits: int, tables: int, seed: int = 11):
        self.dims, self.key_bits, self.tables = dims, bits, tables
        self.one, self.two = Code(dims, max(CODE_BITS, bits * tables), seed), Code(dims, CODE_BITS, seed + 1)
        self.powers = 1 << np.arange(bits, dtype=np.int64)

    def keys(self, signs: np.ndarray) -> np.ndarray:
        """(rows, tables) keys from the bits of the first code."""
        held = signs[:, : self.key_bits * self.tables].reshape(len(signs), self.tables, self.key_bits)
        return held @ self.powers

    def need(self, e: np.ndarray, f: np.ndarray, threshold: float) -> np.ndarray:
        """What the estimate of each pair must reach."""
        rest = 1 - threshold * threshold
        deviation = np.sqrt((e * e * rest)[:, None] + (f * f * rest)[None] + np.outer(e * e, f * f)) / math.sqrt(max(1, self.dims - 1))
        return threshold - CONFIDENCE * deviation - 1e-9


def plan(n: int, threshold: float) -> tuple[int, int]:
    """Bits of a key and tables for n vectors."""
    bits = min(30, max(4, round(math.log2(max(1, n) / KEY_ROWS))))
    keep = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISS) / math.log(1 - keep)))


def _units(vectors, dims: int) -> np.ndarray:
    x = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        x[i, : len(v)] = v
    x /= np.abs(x).max(1, keepdims=True)  # else squares of huge or tiny components leave the doubles
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pairs(codes: Codes, threshold: float, table: int, part: pd.DataFrame):
    """Blocks (i, j) of rows of one key that meet in no earlier table, whose estimate is left; across its two
    blocks where it has two."""
    signs, x, e = codes.one.decode(part["one"].tolist(), part["a"].to_numpy().astype(float))
    _, y, f = codes.two.decode(part["two"].tolist(), part["b"].to_numpy().astype(float))
    keys, mine = codes.keys(signs), part["mine"].to_numpy()
    apart = part["x"].iat[0] != part["y"].iat[0]
    for lo in range(0, len(part), AT_ONCE):
        estimate = x[lo : lo + AT_ONCE] @ y.T
        i, j = np.nonzero(estimate >= codes.need(e[lo : lo + AT_ONCE], f, threshold))
        i += lo
        left = (i < j) & (mine[i] != mine[j]) if apart else i < j
        i, j = i[left], j[left]
        for t in range(table):
            left = keys[i, t] != keys[j, t]
            i, j = i[left], j[left]
        yield i, j


def _exact(codes: Codes, threshold: float, table: int, part: pd.DataFrame):
    """Links between the rows of one key, of which the vectors are there: links counted per row, and a spanning
    forest. The pairs are those of ``_pairs``."""
    unit, ids, mult = _units(part["v"], codes.dims), part["cid"].to_numpy(), part["n"].to_numpy()
    found = np.zeros(len(ids), dtype=np.int64)
    i_all, j_all = [], []
    for i, j in _pairs(codes, threshold, table, part):
        exact = np.concatenate([np.einsum("ij,ij->i", unit[i[s : s + 65536]], unit[j[s : s + 65536]]) for s in range(0, len(i), 65536)]) if len(i) else np.zeros(0)
        left = exact >= threshold
        i_all.append(i[left])
        j_all.append(j[left])
    i, j = np.concatenate(i_all), np.concatenate(j_all)
    np.add.at(found, i, mult[j])
    np.add.at(found, j, mult[i])
    return ids, found, *_forest(ids, i, j)


def _by_key(batches, block):
    """What ``block`` gives for the rows of each key and pair of blocks, which follow one another."""
    rest = None
    for b in batches:
        if rest is not None:
            b = pd.concat([rest, b], ignore_index=True)
        if not len(b):
            continue
        mark = b[["key", "x", "y"]].to_numpy()
        bounds = [0, *(np.flatnonzero((mark[1:] != mark[:-1]).any(1)) + 1), len(b)]
        out = [made for lo, hi in zip(bounds[:-2], bounds[1:-1], strict=True) if hi - lo > 1 and (made := block(b.iloc[lo:hi])) is not None]
        if out:
            yield pd.concat(out, ignore_index=True)
        rest = b.iloc[bounds[-2] :].reset_index(drop=True)
    if rest is not None and len(rest) > 1 and (made := block(rest)) is not None:
        yield made


def _forest(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked row with the least id that links reach, by repeated minima."""
    label = np.arange(len(ids))[np.argsort(np.argsort(ids, kind="stable"), kind="stable")]
    by_rank = np.sort(ids, kind="stable")
    while True:
        before = label.copy()
        np.minimum.at(label, i, before[j])
        np.minimum.at(label, j, before[i])
        inverse = np.empty(len(ids), dtype=np.int64)
        inverse[np.argsort(np.argsort(ids, kind="stable"), kind="stable")] = np.arange(len(ids))
        label = label[inverse[label]]
        if (label == before).all():
            break
    moved = by_rank[label] != ids
    return ids[moved], by_rank[label][moved]


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each row of ``vectors``: vec_id, n_links (other vectors of cosine >= ``threshold``,
    computed in double precision), component_id (least vec_id that links reach, its own included) and
    kept (vec_id = component_id).

    Vectors that are null, zero or empty, or hold null or non-finite components, link with nothing;
    a shorter vector counts as ended by zeros. Rows with equal vectors link with each other. Rows
    that share an id are judged each by its own vector. Null ids link with nothing. An empty table gives no
    rows and other columns are ignored.
    """
    spark = vectors.sparkSession
    v = F.col(vector).cast("array<double>")
    fit = F.col(id).isNotNull() & usable(F.col(vector)) & F.exists(v, lambda x: x != 0)
    # -0.0 + 0.0 is 0.0, so equal vectors have equal bytes; floats stay floats on their way
    kind = "array<float>" if dict(vectors.dtypes)[vector] == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.when(fit, F.transform(v, lambda x: x + F.lit(0.0))).cast(kind).alias("v"))
    classes = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()))
    n, dims = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    member = rows.join(classes, "v", "left").select("vec_id", "cid", "rep", "n")
    if not n:
        return member.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    codes = Codes(dims, *plan(n, threshold))

    def encode(batches):
        for b in batches:
            if len(b):
                unit = _units(b["v"], dims)
                (one, a), (two, f) = codes.one.encode(unit), codes.two.encode(unit)
                packed = [[r.tobytes() for r in np.packbits(s, axis=1)] for s in (one, two)]
                yield pd.DataFrame({"cid": b["cid"], "one": packed[0], "two": packed[1], "a": a.astype("float32"), "b": f.astype("float32"), "keys": list(codes.keys(one) + (np.arange(codes.tables) << 32))})

    coded = written(classes.select("cid", "v").mapInPandas(encode, "cid long, one binary, two binary, a float, b float, keys array<long>"))
    spread = coded.select("cid", "one", "two", "a", "b", F.explode("keys").alias("key"))
    # keys with more rows than a block; a key of one row meets nothing and says nothing
    hot = written(coded.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("held")).where(F.col("held") > BLOCK))
    many = hot.count()
    met = spread.join(F.broadcast(hot) if many <= BROADCAST_KEYS else hot, "key", "left")
    blocks = F.ceil(F.coalesce("held", F.lit(1)) / F.lit(float(BLOCK))).cast("int")
    dealt = met.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    # a block meets each other block once, and itself in the meeting with none
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("mine")).alias("x"), F.greatest(o, F.col("mine")).alias("y")))
    dealt = dealt.withColumn("p", F.explode(pairs)).select("key", F.col("p.x").alias("x"), F.col("p.y").alias("y"), "mine", "cid", "one", "two", "a", "b")
    where = ["key", "x", "y"]
    width = codes.one.bits // 8 + CODE_BITS // 8 + 80

    def in_blocks(table: DataFrame, size: int) -> DataFrame:
        return table.repartition(tasks_for(spark, size), *where).sortWithinPartitions(*where)

    def left(batches):
        def block(part):
            seen = np.zeros(len(part), dtype=bool)
            for i, j in _pairs(codes, threshold, int(part["key"].iat[0]) >> 32, part):
                seen[i] = seen[j] = True
            return part[seen] if seen.any() else None

        yield from _by_key(batches, block)

    kept = written(in_blocks(dealt, n * codes.tables * width).mapInPandas(left, dealt.schema))
    fetched = kept.join(classes.select("cid", "v", "n"), "cid")

    def solve(batches):
        def block(part):
            ids, found, node, into = _exact(codes, threshold, int(part["key"].iat[0]) >> 32, part)
            some = found > 0
            if not some.any():
                return None
            return pd.concat([pd.DataFrame({"cid": ids[some], "found": found[some], "into": None}), pd.DataFrame({"cid": node, "found": 0, "into": into})], ignore_index=True).astype({"into": "Int64"})

        yield from _by_key(batches, block)

    found = written(in_blocks(fetched, kept.count() * (width + 8 * dims)).mapInPandas(solve, "cid long, found long, into long"))
    drop(kept, coded)
    links = found.groupBy("cid").agg(F.sum("found").alias("found"))
    whole = components(found.where("into is not null").select(F.col("cid").alias("a"), F.col("into").alias("b"))).withColumnRenamed("node", "cid")
    least = whole.join(classes.select("cid", "rep"), "cid").groupBy("component").agg(F.min("rep").alias("least"))
    per_class = links.join(whole, "cid", "left").join(least, "component", "left").select("cid", "found", "least")
    out = member.join(per_class, "cid", "left")
    component = F.coalesce("least", "rep", "vec_id")
    n_links = F.coalesce(F.col("n") - 1, F.lit(0)) + F.coalesce("found", F.lit(0))
    return out.select("vec_id", n_links.cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
