"""What the operators of this package share: the shared folder, lineage cuts, unique ids, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir).

    Where it is unset, a local session, as in tests, gets a temporary folder; a cluster is an error, as executors
    could not see each other's files.
    """
    if given := spark.sparkContext.getConf().get("spark.checkpoint.dir"):
        return given
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="lexforge-"))
    return _own[0]


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    df.write.parquet(path := table_path(spark, name))
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a frame that written() made, once no later step reads it."""
    jvm = df.sparkSession._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def one_row_per_id(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) with one row per id: rows that share an id, null among them, count as the greatest value.

    Only the id column is read to see whether any id repeats; when none does, nothing is shuffled but ids.
    """
    rows = df.select(F.col(key), F.col(value))
    repeated = rows.groupBy(key).count().filter("count > 1").limit(1).count()
    return rows.groupBy(key).agg(F.max(value).alias(value)) if repeated else rows


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id that each end of an edge reaches, by alternating large and small stars.

    Every round rewires each node to the smallest id next to it, so a component of any shape shrinks to a star in
    about log(size) rounds; hubs are aggregated with map-side partial minima, and no adjacency list is built.
    """
    flat = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    both = lambda e: e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    now = written(flat.distinct(), "edges")
    last = None
    while True:
        # large star: every greater neighbour of u goes to the least of u and its neighbours
        near = both(now)
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its lesser neighbours go to the least of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        out = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(least.select("u", F.col("m").alias("v")))
        new = written(out.distinct(), "edges")
        mark = new.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first()
        dropped(now)
        if mark == last:
            break
        now, last = new, mark
    return new.select(F.col("u").alias("id"), F.col("v").alias("component")).union(new.select(F.col("v"), F.col("v"))).distinct()
