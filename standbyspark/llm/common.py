"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What may be broadcast: rows of a few numbers (so at most 32 MB or so), and bytes where rows have no fixed size.
BROADCAST_ROWS, BROADCAST_BYTES = 2_000_000, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run; once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share; one of our own only where none is set, on one machine."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame, narrow: bool = False) -> DataFrame:
    """Cut the lineage through the shared folder.

    ``narrow`` is for tables with few bytes a row: an exchange, which keeps the work before it as wide as it was, takes them
    to a quarter of the shuffle partitions, so to fewer files.
    """
    if narrow:
        df = df.repartition(max(6, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4))
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet in the shared folder and read again, and the path of its files."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def forgotten(spark: SparkSession, path: str) -> None:
    """Remove the files of a stage that nothing reads any more."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS, size: Column | None = None) -> DataFrame:
    """``df`` (cheap to recompute) with a broadcast hint if it is small enough, else as it is.

    That is at most ``max_rows`` rows, and at most ``BROADCAST_BYTES`` in sum of ``size``, which rows with strings or arrays need.
    """
    if size is not None:
        total = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size")).collect()[0]
        return F.broadcast(df) if total["n"] <= max_rows and total["size"] <= BROADCAST_BYTES else df
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; null ids have null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (case-insensitively)."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name
