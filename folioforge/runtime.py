"""Session-level helpers: table access, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows above which a lookup side is joined by shuffle instead of broadcast.
BROADCAST_ROWS = 200_000
#: and bytes of text in it above which it is too
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for lineage cuts.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset and
    the master is local a temporary folder of this machine is used.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if named:
        if not current.isDefined():
            sc.setCheckpointDir(named)
        return named
    if current.isDefined():
        return current.get()
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="folioforge-")
    sc.setCheckpointDir(made)
    return made


def materialize(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` as a compressed table in the shared folder and read it back.

    Cuts lineage like ``checkpoint()``, but columnar and compressed, and every
    later read prunes columns. The table is removed when the driver exits.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def still_there(df: DataFrame) -> bool:
    """Whether a table that :func:`materialize` wrote is still in the shared folder, which others may clear."""
    sc = df.sparkSession.sparkContext
    files = df.inputFiles()
    return bool(files) and all(p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p) for p in (sc._jvm.org.apache.hadoop.fs.Path(f) for f in files[:1]))


def _remove(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the session may be gone by now
        pass


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if ``df`` has at most ``limit`` rows and ``most_bytes`` of text, else ``df`` for a shuffled join.

    Counts no further than ``limit``; give it a written table, for what it is given is made for the check and again for the join.
    """
    width = sum((F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) if f.dataType.simpleString() in ("string", "binary") else F.lit(16) for f in df.schema.fields), F.lit(0))
    rows, size = df.limit(limit + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if rows <= limit and size <= most_bytes else df


def partitions_for(rows: int, per_task: int, spark: SparkSession) -> int:
    """Enough partitions that a task holds about ``per_task`` rows, never below the session's default."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))
