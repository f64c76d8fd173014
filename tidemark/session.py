"""Session defaults and shared-folder materialisation."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, SparkSession] = {}


def local_session(cores: int = 8, app: str = "tidemark") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where that is unset (local runs)."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is None:
        return
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    It cuts lineage like checkpoint(), but columnar and compressed, and the
    planner then knows the size. The files survive the loss of executors; they
    are removed by release() or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def forget_later(spark: SparkSession, path: str) -> str:
    """`path`, which is removed when the driver ends."""
    _written[path] = spark
    return path


def release(df: DataFrame) -> None:
    """Remove what materialize() wrote, once nothing that is still to run reads it."""
    path = getattr(df, "_tidemark_path", None)
    if path and _written.pop(path, None):
        _delete(df.sparkSession, path)


@atexit.register
def _cleanup() -> None:
    for path, spark in list(_written.items()):
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone already
            pass
    _written.clear()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a context, for functions that run in Python there. It goes through the shared folder."""
    import io
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root, packed = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    target = f"{shared_folder(spark)}/tidemark/code-{uuid.uuid4().hex}.zip"
    p = sc._jvm.org.apache.hadoop.fs.Path(target)
    out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(target)
    _written[target] = spark
    _shipped.add(sc.applicationId)
