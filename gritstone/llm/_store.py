"""Written tables in the folder that all machines share, used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of our own by application: Spark lets no running session change ``spark.checkpoint.dir``.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only where it is unset (tests) a folder of our own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        app = spark.sparkContext.applicationId
        where = _OWN.get(app) or _OWN.setdefault(app, "file://" + tempfile.mkdtemp(prefix="gritstone-"))
    return where.rstrip("/")


def keep(df: DataFrame, narrow: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it again.

    The files survive the loss of executors, and what is read twice is computed once. A ``narrow`` table (ids, hashes, pairs) goes to
    an eighth of the shuffle partitions, two for each core at least: on a local disk Hadoop starts a process (chmod) for each file and
    folder, and for that moment the executor's memory counts twice.
    """
    spark = df.sparkSession
    if narrow:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.coalesce(max(2 * spark.sparkContext.defaultParallelism, -(-partitions // 8)))
    path = f"{shared_folder(spark)}/gritstone-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._gritstone_path = path  # type: ignore[attr-defined]
    return out


def drop(*tables: DataFrame) -> None:
    """Delete written tables that no later step reads."""
    for t in tables:
        path = getattr(t, "_gritstone_path", None)
        if path:
            spark = t.sparkSession
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
