"""What the operators of this subpackage share: durable intermediate tables, global ranks and
connected components.

Intermediate results go through ``checkpoint()`` or a Parquet table in the folder named by
``spark.checkpoint.dir``, so a lost executor never costs more than the tasks it was running.
"""

from __future__ import annotations

import atexit
import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG_MIN = -(2**63)

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the session's setting, or a temporary folder
    where none is set and the master is local."""
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="attesta-")
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept by ``checkpoint()``: for narrow tables."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, codec: str = "snappy", group: int | None = None) -> DataFrame:
    """``df`` computed once and kept as Parquet in the shared folder: for wide tables, and where
    later joins must deal out their rows anew (a file carries no partitioning, so AQE can split
    its hot keys). ``group``: rows of a row group, where rows are large."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    out = df.write.option("compression", codec)
    (out if group is None else out.option("parquet.block.row.count.limit", group)).parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._attesta_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes tables made by ``written`` that nothing reads any more."""
    for table in tables:
        path = getattr(table, "_attesta_path", None)
        if path:
            _delete(table.sparkSession, path)


def mark() -> int:
    """A point in time, for ``drop_since``."""
    return len(_written)


def drop_since(point: int, *kept: DataFrame) -> None:
    """Deletes the tables that ``written`` has made since then, but for these."""
    stay = {getattr(table, "_attesta_path", None) for table in kept}
    for spark, path in _written[point:]:
        if path not in stay:
            _delete(spark, path)
    _written[point:] = [held for held in _written[point:] if held[1] in stay]


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where the table has columns of that name, in any case."""
    held, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in held:
            name += "_"
        out.append(name)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the JVM may be gone by now; the cluster's own cleaning takes the rest
            return


def worker_cache(owner: str) -> dict:
    """What a Python worker keeps from task to task, for one operator at a time: another's goes, as
    workers outlive a job. It stands beside the interpreter's modules, as functions sent to workers
    bring globals of their own each time."""
    held = sys.modules.setdefault("_attesta_cache", {})
    if held.get("owner") != owner:
        held.clear()
        held["owner"] = owner
    return held


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Bounds the session's Arrow batches by bytes: with long texts the usual 64 MB stand in a task's
    memory several times, in the JVM and in its Python worker."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name, "64m")))
    if held <= 0 or held > most:
        spark.conf.set(name, str(most))


def map_small(df: DataFrame, run, schema: str, rows: int = 256, arrow: bool = False) -> DataFrame:
    """``mapInPandas`` for long texts: ``run`` gets frames of at most ``rows`` rows, so that a task holds
    few texts as Python strings, whatever Arrow's batches. Whole numbers stay whole beside nulls. With
    ``arrow`` it gets record batches instead and gives frames or lists of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(df.sparkSession)
    kind = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def small(batches):
        for b in batches:
            for lo in range(0, b.num_rows, rows):
                part = b.slice(lo, rows)
                yield part if arrow else part.to_pandas(integer_object_nulls=True)

    def mapped(batches):
        import pyarrow as pa

        for made in run(small(batches)):
            if isinstance(made, list):
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(made, kind, strict=True)], schema=kind)
            else:
                yield pa.RecordBatch.from_pandas(made, schema=kind, preserve_index=False)

    return df.mapInArrow(mapped, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tasks_for(spark: SparkSession, size: int, most: int = 64 << 20) -> int:
    """Tasks for a shuffle of about ``size`` bytes: the session's number, or more where these would hold more
    than ``most`` bytes each."""
    return max(partitions(spark), -(-int(size) // most))


def ranked(df: DataFrame, order: list[str], name: str, weight: str | None = None) -> DataFrame:
    """Adds ``name``: the row's place from 0 in the order of the columns ``order`` over the whole
    table, or with ``weight`` the sum of that column over the rows before it.

    Rows are dealt out by range and counted within their partition; only one number for each
    partition reaches the driver. Rows equal in ``order`` take places in any order.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    keys = [F.col(c) for c in order]
    dealt = df.repartitionByRange(partitions(spark), *keys).withColumn("__part", F.spark_partition_id())
    within = Window.partitionBy("__part").orderBy(*keys)
    before = F.row_number().over(within).cast("long") - 1
    if weight:
        before = F.sum(weight).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(weight)
    kept = durable(dealt.withColumn("__before", before))
    total = F.sum(weight) if weight else F.count("*")
    sums = {r[0]: r[1] for r in kept.groupBy("__part").agg(total).collect()}
    start, at = {}, 0
    for part in sorted(sums):
        start[part], at = at, at + sums[part]
    width = max(start, default=0) + 1
    starts = F.array(*[F.lit(start.get(i, 0)).cast("long") for i in range(width)])
    return kept.withColumn(name, F.get(starts, F.col("__part")) + F.col("__before")).drop("__part", "__before")


#: Rising stretches of ids in a partition up to which a table may count as being in order; bytes of
#: text in a range, and ranges, of a table that is not.
STRETCHES, RANGE_BYTES, MOST_RANGES = 64, 12_000_000, 20_000


def _stretches(batches):
    """(part, n, first, last) for each rising stretch of a partition's ids; n 0: too many."""
    import numpy as np
    import pandas as pd
    from pyspark import TaskContext

    rows: list[list[int]] = []
    for b in batches:
        ids = b["id"].to_numpy()
        if not len(ids):
            continue
        cut = [0, *(np.flatnonzero(ids[1:] <= ids[:-1]) + 1).tolist(), len(ids)]
        if len(cut) > STRETCHES + 2:
            rows = [[0, 0, 0]]
        for lo, hi in zip(cut[:-1], cut[1:], strict=True) if len(cut) <= STRETCHES + 2 else ():
            if rows and lo == 0 and ids[0] > rows[-1][2] and rows[-1][0]:
                rows[-1][0], rows[-1][2] = rows[-1][0] + hi, int(ids[hi - 1])
            else:
                rows.append([hi - lo, int(ids[lo]), int(ids[hi - 1])])
        if len(rows) > STRETCHES or not rows[0][0]:
            rows = [[0, 0, 0]]
            break
    if rows:
        yield pd.DataFrame(rows, columns=["n", "first", "last"], dtype="int64").assign(part=TaskContext.get().partitionId())


def in_order(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, text), of which every partition is made of stretches of rising ids, and no two stretches
    overlap: so one after another, by their first ids, they are the table in the order of its ids. A null
    id is the least; null texts are empty.

    Tables are often stored so, and then stay as they are: only the ids are read to find out. Any other,
    or one that is read in fewer tasks than there are cores, is dealt out by ranges of (id, hash of the
    text), so that rows of one id are not one task's, and sorted within them; rows of one id are in the
    order of that hash.
    """
    rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(LONG_MIN)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = rows.select("id").mapInPandas(_stretches, "n long, first long, last long, part int").toPandas().sort_values("first")
    cores = docs.sparkSession.sparkContext.defaultParallelism
    if found["part"].nunique() >= cores and found["n"].all() and (found["first"].to_numpy()[1:] > found["last"].to_numpy()[:-1]).all():
        return rows
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = min(MOST_RANGES, max(1, -(-total // RANGE_BYTES)))
    tie = F.xxhash64("text")
    return rows.repartitionByRange(ranges, "id", tie).sortWithinPartitions("id", tie)


LOCAL_EDGES = 10_000


def _union_find(batches):
    import pandas as pd

    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    yield pd.DataFrame({"node": nodes, "into": [root(x) for x in nodes]}, dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected graph with the edges (a long, b long).

    Returns (node, component): one row for each node of an edge, with the smallest node of its
    component. Loops, repeated edges and an empty table are fine; null ends are not allowed.

    Each round every node moves to the least of itself and its neighbours, in the order of the
    ids in even rounds and of a hash that changes with the round in odd ones; edges between
    nodes that moved together vanish. A path loses a constant share of its nodes each odd round, a
    star collapses in an even one, so the rounds grow as the logarithm of the graph. Minima are
    aggregated before they are shuffled, and all joins read plain files, so that AQE can split a
    hot node. Once at most ``LOCAL_EDGES`` edges are left, one task finishes them.
    """
    a, b = F.col("a"), F.col("b")
    left = written(edges.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct())
    labels = None
    turn = 0
    while n := left.count():
        if n <= LOCAL_EDGES:
            moves = written(left.coalesce(1).mapInPandas(_union_find, "node long, into long"))
        else:
            by = (lambda c: c) if turn % 2 == 0 else (lambda c, t=turn: F.xxhash64(c, F.lit(t)))
            ends = left.select(a.alias("node"), b.alias("other")).unionByName(left.select(b.alias("node"), a.alias("other")))
            least = ends.groupBy("node").agg(F.min(F.struct(by(F.col("other")).alias("by"), F.col("other").alias("id"))).alias("m"))
            own = F.struct(by(F.col("node")).alias("by"), F.col("node").alias("id"))
            moves = written(least.select("node", F.least(own, F.col("m"))["id"].alias("into")))
        if labels is None:
            labels = moves.select("node", F.col("into").alias("label"))
        else:
            step = moves.select(F.col("node").alias("label"), "into")
            labels = written(labels.join(step, "label", "left").select("node", F.coalesce("into", "label").alias("label")))
        if n <= LOCAL_EDGES:
            break
        to_a = moves.select(F.col("node").alias("a"), F.col("into").alias("x"))
        to_b = moves.select(F.col("node").alias("b"), F.col("into").alias("y"))
        moved = left.join(to_a, "a").join(to_b, "b").where("x <> y")
        after = written(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        drop(left)
        left, turn = after, turn + 1
    if labels is None:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(smallest, "label").select("node", "component")
