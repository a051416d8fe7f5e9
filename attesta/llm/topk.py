"""Exact top-k inner products: a Voronoi kNN join.

Pivots, about as many as the root of the rows, are drawn from the vectors, and every vector joins the
cell of the pivot that is nearest in direction. A cell is summarised by its number of rows and by the
ranges of their norms and of their angles to the pivot. For a query at angle u from the pivot, rows at
angles from lo to hi and norms from s to l,

    q.x <= |q| n cos(max(0, u - hi, lo - u)),  n = l, or s where the cosine is negative,
    q.x >= |q| n cos(min(pi, u + hi)),         n = s, or l where the cosine is negative.

Queries are grouped by cell as well: all queries of a cell lie within some angle of its pivot, which
widens both bounds by that angle. The k-th best of the lower bounds is a score that every query of the
group is sure to reach, so a cell whose upper bound lies below it is not sent to that group. Near query
cells that need about the same rows are one group. Each group is solved locally: its rows are dealt into
blocks of bounded size, so no group, however hot, is one task. In a block each query's best cell gives a
score to beat; the cells are then visited from the best upper bound on, each by the queries whose own
bound for it reaches what they have. What the blocks keep is merged per query.

Scores are exact integers: components are floor(scale * x) in double precision. Where sums could leave
the integers of a double, components are split into limbs, and Python's integers take over for those
beyond 2**53. Scores beyond a long saturate.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.runtime import written

#: Most pivots (a bounded sample), rows of a block, queries of a group, and rows compared at once.
PIVOTS, BLOCK, QUERIES_A_GROUP, AT_ONCE = 2_048, 16_384, 4_096, 1_024
#: A query cell joins a group if the rows that both need are at most so many times what the larger needs.
ALIKE = 1.25
_EXACT = float(2**53)
_LONG = 2**63 - 1
_LIMB = 18


def usable(vec: Column) -> Column:
    """True for a vector that is not null and holds no null or non-finite component."""
    v = vec.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _matrix(vectors, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, : min(len(v), dims)] = v[:dims]
    return out


def _polar(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and norms; a zero vector has none. Norms beyond the doubles are infinite."""
    most = np.abs(x).max(1, initial=0)
    scaled = x / np.where(most > 0, most, 1)[:, None]
    length = np.linalg.norm(scaled, axis=1)
    with np.errstate(over="ignore"):
        return scaled / np.where(length > 0, length, 1)[:, None], length * most


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def _reach(low_angle, high_angle, small, large) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of |x| cos(angle), from below and above, over ranges of angles and norms."""
    worst, best = np.cos(np.minimum(np.pi, high_angle + 1e-7)), np.cos(np.maximum(0, low_angle - 1e-7))
    with np.errstate(invalid="ignore"):
        low = np.where(worst >= 0, small, large) * worst
        high = np.where(best >= 0, large, small) * best
    return np.nan_to_num(low, nan=-np.inf, posinf=np.inf, neginf=-np.inf), np.nan_to_num(high, nan=np.inf, posinf=np.inf, neginf=-np.inf)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    sign, left = np.sign(x), np.abs(x).astype(np.int64)
    return [sign * ((left >> (_LIMB * i)) & ((1 << _LIMB) - 1)) for i in range(3)]


def _whole(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """By Python's integers, for any size."""
    a, b = (np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in (q, x))
    return np.clip(a @ b.T, -_LONG, _LONG).astype(np.int64)


def _split(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """By limbs of 18 bits, for components below 2**53: products of limbs are exact, and their shifted sum
    is right modulo 2**64; its size as a double tells which scores saturate."""
    parts = [np.zeros((len(q), len(x))) for _ in range(5)]
    for i, a in enumerate(_limbs(q)):
        for j, b in enumerate(_limbs(x)):
            parts[i + j] += a @ b.T
    size = sum(p * float(1 << (_LIMB * s)) for s, p in enumerate(parts))
    off = sum(np.abs(p) * float(1 << (_LIMB * s)) for s, p in enumerate(parts)) * 2.0**-48
    out = sum(p.astype(np.int64) << np.int64(_LIMB * s) for s, p in enumerate(parts) if _LIMB * s < 64)
    out = np.where(size > 2.0**62, _LONG, np.where(size < -(2.0**62), -_LONG, out))
    for i, j in np.argwhere((np.abs(size) + off > 2.0**62) & (np.abs(size) - off < 2.0**64)):
        out[i, j] = _whole(q[i : i + 1], x[j : j + 1])[0, 0]
    return out


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    fits = (_EXACT / max(1, q.shape[1])) ** 0.5
    of_q, of_x = (np.where((m := np.abs(v).max(1, initial=0)) <= fits, 0, np.where(m < _EXACT, 1, 2)) for v in (q, x))
    if not of_q.any() and not of_x.any():
        return (q @ x.T).astype(np.int64)
    out = np.zeros((len(q), len(x)), dtype=np.int64)
    for a in np.unique(of_q):
        for b in np.unique(of_x):
            rows, cols = np.flatnonzero(of_q == a), np.flatnonzero(of_x == b)
            how = (lambda p, r: (p @ r.T).astype(np.int64), _split, _whole)[max(a, b)]
            out[np.ix_(rows, cols)] = how(q[rows], x[cols])
    return out


def _solve(k: int, dims: int, pivots: np.ndarray):
    least = -_LONG - 1

    def block(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "quid": [], "seen": []}, dtype="int64")
        q, quid = _matrix(queries["q"], dims), queries["quid"].to_numpy()
        turn, length = _polar(q)
        cell, norm, angle = (rows[c].to_numpy() for c in ("cell", "norm", "angle"))
        cells, of = np.unique(cell, return_inverse=True)
        span = [np.full(len(cells), s) for s in (np.inf, -np.inf, np.inf, -np.inf)]
        for at, by, v in zip(span, (np.minimum, np.maximum) * 2, (norm, norm, angle, angle), strict=True):
            by.at(at, of, v)
        u = _angles(turn, pivots[cells])
        _, up = _reach(np.maximum(u - span[3], span[2] - u), u + span[3], span[0], span[1])
        with np.errstate(invalid="ignore"):
            up = np.nan_to_num(up * length[:, None] * (1 + 1e-9), nan=np.inf, posinf=np.inf, neginf=-np.inf)
        up = np.where(up < 0, up * (1 - 2e-9), up) + 1e-6
        # rows in the order of their cells, the cells in the order of their best bound
        order = np.argsort(-up.max(0), kind="stable")
        rank = np.empty(len(cells), np.int64)
        rank[order] = np.arange(len(cells))
        by = np.argsort(rank[of], kind="stable")
        x, ids, uid, up = _matrix(rows["v"].iloc[by], dims), rows["id"].to_numpy()[by], rows["uid"].to_numpy()[by], up[:, order]
        ends = np.cumsum(np.bincount(rank[of], minlength=len(cells)))
        place = {n: i for i, n in enumerate(uid.tolist())}
        own = np.array([place.get(n, -1) for n in quid.tolist()])

        def scores(act, lo, hi):
            s = _scores(q[act], x[lo:hi])
            mine = np.flatnonzero((own[act] >= lo) & (own[act] < hi))
            s[mine, own[act][mine] - lo] = least
            return s

        # a score to beat: the k-th of the query's best cell
        beat = np.full(len(q), least)
        best = up.argmax(1)
        for c in np.unique(best):
            lo, hi = (ends[c - 1] if c else 0), ends[c]
            if min(hi - lo, AT_ONCE) > k:
                act = np.flatnonzero(best == c)
                beat[act] = np.partition(scores(act, lo, min(hi, lo + AT_ONCE)), min(hi - lo, AT_ONCE) - k, 1)[:, -k]
        top = np.full((len(q), k), least)
        found, seen, c = [], np.zeros(len(q), np.int64), 0
        while c < len(cells):
            lo = ends[c - 1] if c else 0
            after = max(c + 1, int(np.searchsorted(ends, lo + AT_ONCE, "right")))
            act = np.flatnonzero(up[:, c:after].max(1) >= beat * (1 - np.sign(beat) * 1e-9))
            for a in range(lo, ends[after - 1] if len(act) else lo, AT_ONCE):
                b = min(a + AT_ONCE, ends[after - 1])
                s = scores(act, a, b)
                seen[act] += b - a
                top[act] = np.partition(np.concatenate([top[act], s], 1), b - a, 1)[:, -k:]
                beat[act] = np.maximum(beat[act], top[act].min(1))
                i, j = np.nonzero((s >= beat[act][:, None]) & (s > least))
                found.append((act[i], a + j, s[i, j]))
            c = after
        i, j, s = (np.concatenate(f) for f in zip(*found, strict=True))
        left = s >= beat[i]
        i, j, s = i[left], j[left], s[left]
        by = np.lexsort((ids[j], -s, i))
        i, j, s = i[by], j[by], s[by]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        i, j, s, nth = (v[nth < k] for v in (i, j, s, nth))
        return pd.DataFrame({"query_id": queries["query_id"].to_numpy()[i], "vec_id": ids[j], "score": s, "quid": quid[i], "seen": np.where(nth == 0, seen[i], 0)})

    return block


def _groups(cells: pd.DataFrame, pivots: np.ndarray, k: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Of the cells' summary: (cell, grp, parts, blocks) of the query cells, and (cell, to), the groups that need
    the rows of a cell: at most as many as there are pairs of cells."""
    p, size = pivots[cells["cell"].to_numpy()], cells["n"].to_numpy()
    asked = np.flatnonzero(cells["queries"].to_numpy() > 0)
    # near cells follow one another: by the main direction of the pivots
    asked = asked[np.argsort(p[asked] @ np.linalg.svd(p, full_matrices=False)[2][0], kind="stable")]
    small, large, lo, hi = (cells[c].to_numpy() for c in ("small", "large", "lo", "hi"))
    groups: list[tuple[list[int], int, np.ndarray]] = []
    for i in asked.tolist():
        u, wide, n = _angles(p[i : i + 1], p)[0], float(cells["wide"].iat[i]), int(cells["queries"].iat[i])
        low, up = _reach(np.maximum(u - wide - hi, lo - u - wide), u + wide + hi, small, large)
        by = np.argsort(-low, kind="stable")
        enough = np.cumsum(size[by]) > k
        sure = low[by][enough.argmax()] if enough.any() else -np.inf
        need = up * (1 + np.sign(up) * 1e-9) + 1e-9 >= sure if np.isfinite(sure) else np.ones(len(size), dtype=bool)
        if groups and groups[-1][1] + n <= QUERIES_A_GROUP:
            both = groups[-1][2] | need
            if size[both].sum() <= ALIKE * max(size[groups[-1][2]].sum(), size[need].sum()):
                groups[-1] = ([*groups[-1][0], i], groups[-1][1] + n, both)
                continue
        groups.append(([i], n, need))
    place, to = [], [[] for _ in size]
    for g, (members, n, need) in enumerate(groups):
        parts, blocks = -(-n // QUERIES_A_GROUP), max(1, int(-(-size[need].sum() // BLOCK)))
        place += [(int(cells["cell"].iat[i]), g, parts, blocks) for i in members]
        for c in np.flatnonzero(need).tolist():
            to[c].append(g)
    return pd.DataFrame(place, columns=["cell", "grp", "parts", "blocks"]), pd.DataFrame({"cell": cells["cell"], "to": to})


def _joined(vectors: DataFrame, is_query, k: int, scale: float, id: str, vector: str, seed: int) -> DataFrame | None:
    """(query_id, vec_id, score, quid, seen): each block's best rows for each query; seen adds up to the rows
    that the query was compared with."""
    spark = vectors.sparkSession
    held = vectors.where(F.col(id).isNotNull() & usable(F.col(vector)))
    ints = F.transform(F.col(vector).cast("array<double>"), lambda x: _floor(x * F.lit(scale)))
    read = held.select(F.col(id).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("is_q"), ints.alias("v"))
    n, n_q, dims = read.agg(F.count("*"), F.count_if("is_q"), F.max(F.size("v"))).first()
    if not n or not n_q:
        return None
    dims = max(1, dims)
    drawn = read.select("v", F.xxhash64("id", "v", F.lit(seed)).alias("h")).orderBy("h").limit(min(PIVOTS, int(n**0.5) + 1)).select("v").collect()
    pivots = np.unique(_polar(_matrix([r[0] for r in drawn], dims))[0], axis=0)

    def assign(batches):
        for b in batches:
            if len(b):
                turn, norm = _polar(_matrix(b["v"], dims))
                near = turn @ pivots.T
                cell = near.argmax(1)
                yield b.assign(cell=cell.astype("int32"), norm=norm, angle=np.arccos(np.clip(near[np.arange(len(b)), cell], -1, 1)))

    celled = read.mapInPandas(assign, "id long, is_q boolean, v array<double>, cell int, norm double, angle double")
    celled = written(celled.withColumn("uid", F.monotonically_increasing_id()))
    sums = (F.count("*").alias("n"), F.min("norm").alias("small"), F.max("norm").alias("large"), F.min("angle").alias("lo"), F.max("angle").alias("hi"))
    asked = (F.count_if("is_q").alias("queries"), F.max(F.when(F.col("is_q"), F.col("angle"))).alias("wide"))
    place, to = _groups(celled.groupBy("cell").agg(*sums, *asked).orderBy("cell").toPandas(), pivots, k)
    # a row for each cell; pairs of cells bound their size
    to = F.broadcast(spark.createDataFrame(to, "cell int, to array<int>"))
    dealt = F.broadcast(spark.createDataFrame(place[["grp", "parts", "blocks"]].drop_duplicates(), "grp int, parts int, blocks int"))
    place = F.broadcast(spark.createDataFrame(place, "cell int, grp int, parts int, blocks int"))
    rows = celled.join(to, "cell").withColumn("grp", F.explode("to")).join(dealt, "grp").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("id", "uid", "v", "cell", "norm", "angle", "grp", "part", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int").alias("block"))
    queries = celled.where("is_q").join(place, "cell").withColumn("part", F.pmod(F.xxhash64("uid", F.lit(1)), F.col("parts")).cast("int"))
    queries = queries.select(F.col("id").alias("query_id"), F.col("uid").alias("quid"), F.col("v").alias("q"), "grp", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    by = ["grp", "part", "block"]
    return queries.groupBy(*by).cogroup(rows.groupBy(*by)).applyInPandas(_solve(k, dims, pivots), "query_id long, vec_id long, score long, quid long, seen long")


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, id: str = "vec_id", vector: str = "embedding", seed: int = 7) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k rows of the highest integer inner product for
    each row where the condition ``is_query`` holds, among all other rows, ties to the smaller id.

    Vectors that are null or hold null or non-finite components take no part on either side; a
    shorter vector counts as ended by zeros. Null ids take no part. A row that repeats another's
    id and vector is a row of its own and a candidate for it. With fewer than k others a query gets
    them all; an empty table gives no rows; other columns are ignored.
    """
    found = _joined(vectors, is_query, k, scale, id, vector, seed)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("quid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def compared(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, id: str = "vec_id", vector: str = "embedding", seed: int = 7) -> int:
    """Pairs of a query and a row whose score ``top_k`` computes; the rest are settled by bounds."""
    found = _joined(vectors, is_query, k, scale, id, vector, seed)
    return 0 if found is None else found.agg(F.sum("seen")).first()[0] or 0


def _floor(x):
    """floor as a double, also beyond the longs."""
    return F.when(F.abs(x) < F.lit(_EXACT), F.floor(x).cast("double")).otherwise(x)
