"""Session helpers: builder for tests/bench, and Parquet stage tables in the
cluster's shared folder that cut lineage and survive executor loss."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a row group of a stage table, before encoding.
ROW_GROUP_BYTES = 16 << 20

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot never compiles a method of more bytecode; a wide stage beyond it runs
    # operator by operator, each compiled, which is faster than one interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cpus: int | str = "*", app: str = "parcelflow", **conf) -> SparkSession:
    """Local session for tests and the bench. On a cluster use the session the
    platform hands out; nothing here is needed there."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**_LOCAL_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local session (one machine, as
    in tests) gets a scratch folder of its own; a cluster session without the
    setting raises, for each of its machines would write to its own disk."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the folder
        return d or ""
    d = d or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="parcelflow-ckpt-", dir="/tmp")
    if spark.conf.get("spark.checkpoint.dir", None) != d:
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared folder and read it
    back: readers prune columns and push filters down, a lost executor costs a
    re-read and not a replay. Row groups are small, so that the readers of a
    file which one task wrote are many. Each call has a folder of its own, which
    the file system removes when the application ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stages/{name}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)
    try:
        jvm = spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(where)
    except AttributeError:  # Spark Connect: the server's retention rules apply
        pass
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """A stage table without a lasting name."""
    return stage_table(df, "cut")
