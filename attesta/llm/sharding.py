"""Sharding by sampled splitters: shards of near equal bytes, cut from one order of all rows.

The order is by a hash of the text, then of the id, so that equal texts lie together. A
size-weighted sample of keys gives quantile boundaries; every row finds its range by binary
search in the boundaries, inside the plan. Ranges are then measured exactly. Those that came out
overfull, in bytes or rows, and those through which a shard's edge runs, are sampled again and
subdivided, at edges between texts where possible and between ids where one text alone is
overfull. Shards are runs of ranges, so only the few splitters and the ranges' sums reach the
driver: both are bounded by the number of ranges, never by the rows.

DataFrame functions only. No text is shuffled.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate, count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.runtime import LONG_MIN, durable

RANGES_A_SHARD = 64
MAX_RANGES = 16_384
SAMPLES_A_RANGE = 16
#: A range is overfull from this many times its fair share; at a shard's edge from this share of a shard.
OVERFULL, EDGE = 3.0, 0.002

Key = tuple[int, int, int]


def _longs(values: list[int]) -> Column:
    held = ",".join("-9223372036854775807L - 1L" if v == LONG_MIN else f"{v}L" for v in values)
    return F.expr(f"array({held})" if values else "cast(array() as array<bigint>)")


def _range_of(splitters: list[Key]) -> Column:
    """Number of splitters that are at most the row's key (k, t, u): a binary search."""
    if not splitters:
        return F.lit(0)
    arrays = [_longs([s[i] for s in splitters]) for i in range(3)]
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(splitters).bit_length()))])

    def go(at: Column, step: Column) -> Column:
        to = at + step
        k, t, u = (F.get(a, to - 1) for a in arrays)
        held = (k < F.col("k")) | ((k == F.col("k")) & ((t < F.col("t")) | ((t == F.col("t")) & (u <= F.col("u")))))
        return F.when((to <= len(splitters)) & held, to).otherwise(at)

    return F.aggregate(steps, F.lit(0), go)


def _chance(salt: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64("u", "k", F.lit(salt)), 11).cast("double") / float(1 << 53)


def _edges(sample: list[tuple[Key, float]], parts: int, single: bool) -> set[Key]:
    """Boundaries that cut the sampled keys into ``parts`` of equal weight. single: all rows have
    one k, so the cuts go between ids; else they go between texts, with heavy texts set apart."""
    sample = sorted(sample)
    upto = list(accumulate(w for _, w in sample))
    found: set[Key] = set()
    for i in range(1, parts):
        key = sample[min(bisect_right(upto, upto[-1] * i / parts), len(sample) - 1)][0]
        found.add(key if single else (key[0], LONG_MIN, LONG_MIN))
    if not single:
        share: dict[int, float] = {}
        for (k, _, _), w in sample:
            share[k] = share.get(k, 0) + w
        for k, w in share.items():
            if w > 2 * upto[-1] / parts:
                found |= {(k, LONG_MIN, LONG_MIN)} | ({(k + 1, LONG_MIN, LONG_MIN)} if k < 2**63 - 1 else set())
    return found


def shard(docs: DataFrame, shards: int = 16, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row for each row of ``docs``: doc_id, size (UTF-8 bytes and 1), text_crc32, shard (0 to
    ``shards`` - 1) and slot (gapless from 0 within the shard).

    Shards hold near equal bytes: an edge lies within a row, or ``EDGE`` of a shard, of its place.
    Equal texts share a shard but where an edge falls inside a group of copies larger than that.
    Null texts count as empty, null ids are ids, repeated rows are rows of their own; an empty
    table gives no rows and other columns are ignored.
    """
    k = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    base = durable(
        docs.select(
            F.col(id).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(F.col(text)), F.lit(0)).cast("long").alias("text_crc32"),
            k.alias("k"),
            F.xxhash64(F.col(id)).alias("t"),
            F.monotonically_increasing_id().alias("u"),
        )
    )
    rows, total = base.agg(F.count("*"), F.sum("size")).first()
    if not rows:
        return base.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranges = min(MAX_RANGES, max(shards * RANGES_A_SHARD, -(-rows // 500_000)))
    weight = (F.col("size") / F.lit(float(total)) + F.lit(1.0 / rows)) / 2
    p = F.least(F.lit(1.0), weight * (ranges * SAMPLES_A_RANGE))
    drawn = base.where(_chance(0) < p).select("k", "t", "u", weight / p).collect()
    splitters = sorted(_edges([((r[0], r[1], r[2]), r[3]) for r in drawn], ranges, False)) if drawn else []
    for turn in count(1):  # every turn adds boundaries, so overfull ranges come to an end
        at = _range_of(splitters)
        sums = base.groupBy(at.alias("r")).agg(F.sum("size"), F.count("*"), F.min("k") == F.max("k")).collect()
        sums = sorted((r[0], r[1], r[2], r[3]) for r in sums)
        again, upto = {}, 0
        for r, size, n, single in sums:
            edge = upto * shards // total != min((upto + size) * shards // total, shards - 1)
            share = max(size / total, n / rows)
            parts = max(share * ranges / OVERFULL, edge * size * shards / total / EDGE)
            if parts > 1 and n > 1:
                again[r] = (min(64, int(parts) + 2), (size / total + n / rows) / 2, single)
            upto += size
        if not again:
            break
        rate = F.expr("array(" + ",".join(f"{again[r][0] * SAMPLES_A_RANGE / again[r][1]}D" if r in again else "0D" for r in range(len(splitters) + 1)) + ")")
        p = F.least(F.lit(1.0), weight * F.get(rate, at))
        drawn = base.where(_chance(turn) < p).select(at.alias("r"), "k", "t", "u", weight / p).collect()
        found: dict[int, list] = {}
        for r in drawn:
            found.setdefault(r[0], []).append(((r[1], r[2], r[3]), r[4]))
        more = {e for r, sample in found.items() for e in _edges(sample, again[r][0], again[r][2])} - set(splitters)
        if not more:
            break
        splitters = sorted({*splitters, *more})
        sums = []
    at = _range_of(splitters)
    placed = durable(base.withColumn("r", at))
    sums = sums or sorted((r[0], r[1], r[2]) for r in placed.groupBy("r").agg(F.sum("size"), F.count("*")).collect())
    to, start, upto, held = [0] * (len(splitters) + 1), [0] * (len(splitters) + 1), 0, [0] * shards
    for r, size, n, *_ in sums:
        to[r] = min(shards - 1, (2 * upto + size) * shards // (2 * total))
        start[r] = held[to[r]]
        held[to[r]] += n
        upto += size
    within = F.row_number().over(Window.partitionBy("r").orderBy("k", "t", "u"))
    out = placed.withColumn("__n", within)
    shard_of, start_of = F.get(_longs(to), F.col("r")), F.get(_longs(start), F.col("r"))
    return out.select("doc_id", "size", "text_crc32", shard_of.cast("int").alias("shard"), (start_of + F.col("__n") - 1).cast("long").alias("slot"))
