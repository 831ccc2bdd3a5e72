"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that every plan in this package relies on.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even when the aggregate above the join could have
    # reused the join's partitioning; one more small shuffle beats one huge task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Wall-clock timestamps: parsing goes through the session zone, so pin it.
    "spark.sql.session.timeZone": "UTC",
}

# For tables of any size: a shuffle is dealt so finely that no task holds much, and small parts are put
# together again by their size while the query runs. A fixed small number would make tasks grow with the rows.
SCALE_CONF = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
              "spark.sql.parquet.compression.codec": "zstd",     # stored layouts take less room
              # Java never compiles a method of more than 8,000 bytes. Over some fifty columns the code of a
              # stage is one; beyond this limit Spark takes the code it has cut into small methods instead.
              "spark.sql.codegen.hugeMethodLimit": "8000"}

# What a task reads of a shuffle, compressed: in memory, sorted for joins, windows and groups one on the
# other, that is some thirty times as much.
ADVISORY, ADVISORY_MB = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 16


def get_session(app: str = "cargolens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession, fine: bool = False) -> SparkSession:
    """Apply the runtime settings to a session created by someone else, with ``fine`` those of
    ``SCALE_CONF`` and smaller tasks too; without it they are taken back. An advisory size that is
    smaller already stays."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for key, value in SCALE_CONF.items():
        spark.conf.set(key, value) if fine else spark.conf.unset(key)
    ours = f"{ADVISORY_MB}m"
    if not fine:
        if spark.conf.get(ADVISORY, None) == ours:
            spark.conf.unset(ADVISORY)
    elif _bytes(spark.conf.get(ADVISORY)) > ADVISORY_MB << 20:
        spark.conf.set(ADVISORY, ours)
    return spark


def _bytes(size: str) -> int:
    """Of a size as Spark writes it: 67108864b, 64MB, 8m."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a temporary folder, because there every
    task runs on this machine. A ``file:`` folder on a cluster has to be mounted on every machine;
    whether it is can't be seen from here, so that gives a warning.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="cargolens-")
        spark.conf.set("spark.checkpoint.dir", base)
    if base.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        warnings.warn(f"{base} must be a folder that every machine of the cluster mounts")
    return f"{base.rstrip('/')}/cargolens-{spark.sparkContext.applicationId}"


def own_dir(spark: SparkSession, name: str) -> str:
    """A folder of the application that no other call writes to."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_stages(spark: SparkSession) -> None:
    """Remove everything this application has stored; frames read from it can't be used after."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, row_group: int | None = None,
          compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the stored copy.

    Used where a plan reads the same rows in several branches and row numbers
    must not change between them, and so that a lost executor recomputes from
    the stored rows instead of the whole upstream plan. Every call gets a folder of its
    own below the application's folder; ``clear_stages`` removes that when all is done.

    A file is split between tasks at its row groups: ``row_group`` bytes, less than Parquet's usual
    128 MB, let more tasks read rows that cost much to work on. ``compression`` is Parquet's, snappy
    if not given; zstd takes less room for wide rows.
    """
    spark = df.sparkSession
    path = own_dir(spark, f"stage/{name}")
    writer = df.write.option("parquet.block.size", row_group) if row_group else df.write
    (writer.option("compression", compression) if compression else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
