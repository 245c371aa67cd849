"""Cutting lineage in the cluster's shared folder, and connected components on top of it."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one where it is unset and Spark runs locally."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found


def checked(df: DataFrame) -> DataFrame:
    """A reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Spark deletes a query's shuffle files as soon as it ends.
_CLEANS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _delete(spark: SparkSession, path: str) -> None:
    try:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:  # the session is gone
        return


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: cut lineage that outlives an executor.

    The shuffles behind it are deleted at once, the table at the interpreter's end or by :func:`forget`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANS, "false")
    spark.conf.set(_CLEANS, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANS, before)
    atexit.register(_delete, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Deletes the files of :func:`stored` tables, of which these are columns or rows; nothing may read them any more."""
    for df in tables:
        spark = df.sparkSession
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if path.rsplit("/", 2)[-2] == shared_dir(spark).rstrip("/").rsplit("/", 1)[-1]:
                _delete(spark, path)


#: A key is spread by :func:`lookup` if it has more than a thousandth of the rows, and more rows than this.
SPREAD_ROWS = 100


def heavy_keys(rows: DataFrame, key: str, n: int | None = None) -> DataFrame | None:
    """The values of ``key`` that more than a thousandth of ``rows`` have, so at most 1000; None if there are none.

    ``rows`` should be stored or checkpointed: it is read twice, once where its number ``n`` is known.
    """
    level = max(SPREAD_ROWS, (rows.count() if n is None else n) // 1000)
    found = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > level).select(key).collect()
    return rows.sparkSession.createDataFrame(found, rows.select(key).schema) if found else None


def lookup(rows: DataFrame, table: DataFrame, key: str, how: str = "inner", heavy: DataFrame | None = None, known: bool = False) -> DataFrame:
    """``rows`` joined to ``table``, which has one row of a few numbers for each ``key``.

    Rows of heavy keys (found here unless ``known``) don't meet in one task: they stay where they are and the table's
    rows of these keys, at most 1000, are broadcast.
    """
    if not known:
        heavy = heavy_keys(rows, key)
    if heavy is None:
        return rows.join(table, key, how)
    few = F.broadcast(heavy)
    spread = rows.join(few, key, "left_semi").join(F.broadcast(table.join(few, key, "left_semi")), key, how)
    return spread.unionByName(rows.join(few, key, "left_anti").join(table, key, how))


#: Edges that one task contracts at a time.
TASK_EDGES = 200_000


def _contracted(edges: pa.Table) -> pa.Table:
    """(a, b) with a the smallest node that b is connected with, for every node b of the edges (a, b)."""
    ends = pa.chunked_array([*edges.column("a").chunks, *edges.column("b").chunks], edges.schema.field("a").type).combine_chunks()
    nodes = ends.unique()
    nodes = nodes.take(pc.array_sort_indices(nodes))
    codes = pc.index_in(ends, nodes).to_numpy(zero_copy_only=False).astype(np.int64)
    a, b = codes[: len(codes) // 2], codes[len(codes) // 2 :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            return pa.table({"a": nodes.take(pa.array(label)), "b": nodes})
        label = new


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges (a, b) of a task as stars, contracted every TASK_EDGES edges; more stars than that are passed on at once."""
    held: list[pa.Table] = []
    rows = limit = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows > limit + TASK_EDGES:
            held = [_contracted(pa.concat_tables(held))]
            rows = limit = held[0].num_rows
            if limit > TASK_EDGES:
                yield from held[0].combine_chunks().to_batches(max_chunksize=10_000)
                held, rows, limit = [], 0, 0
    if rows:
        yield from _contracted(pa.concat_tables(held)).combine_chunks().to_batches(max_chunksize=10_000)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the edges (a, b).

    Tasks first contract TASK_EDGES edges each, without a shuffle; what one task holds is done by that.  More edges go
    through min-label propagation with pointer jumping, where neither a node of many edges nor a large component is one
    task's.  Each round's tables are deleted once the next ones are written.
    """
    given = stored(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct(), "edges")
    tasks = -(-given.count() // TASK_EDGES)
    stars = stored(given.coalesce(max(1, tasks)).mapInArrow(contract, given.schema), "stars")
    forget(given)
    if tasks <= 1:
        return stars.select(F.col("b").alias("node"), F.col("a").alias("component"))
    found = _propagated(stars)
    forget(stars)
    return found


def _propagated(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("a").alias("x"), F.col("b").alias("y"))
    both = stored(ends.unionByName(ends.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = stored(both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("label")), "labels")
    nodes, hubs = labels.count(), heavy_keys(both, "y")
    while True:
        near = lookup(both, labels.select(F.col("node").alias("y"), "label"), "y", heavy=hubs, known=True).select(F.col("x").alias("node"), "label", F.lit(False).alias("own"))
        own = labels.select("node", "label", F.lit(True).alias("own"))
        met = near.unionByName(own).groupBy("node").agg(F.max(F.when(F.col("own"), F.col("label"))).alias("was"), F.min("label").alias("label"))
        met = stored(met, "labels")
        jump = met.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = lookup(met, jump, "label", "left", heavy_keys(met, "label", nodes), True).select("node", "was", F.coalesce(F.least("label", "next"), "label").alias("label"))
        after = stored(after, "labels")
        forget(met, labels)
        labels = after.select("node", "label")
        if after.where("label <> was").isEmpty():
            forget(both)
            return labels.withColumnRenamed("label", "component")
