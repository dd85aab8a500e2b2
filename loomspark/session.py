"""Session helpers: a local session for tests and benches, and shipping this package to the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """``shared``: the folder for intermediate tables (a core setting, so it must be there when the session starts)."""
    builder = SparkSession.builder if shared is None else SparkSession.builder.config("spark.checkpoint.dir", shared)
    return (
        builder.master(f"local[{cores}]")
        .appName("loomspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; one of our own where that is unset on one machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = getattr(shared_dir, "own", None) or "file://" + tempfile.mkdtemp(prefix="loomspark-")
        shared_dir.own = found  # type: ignore[attr-defined]
    return found.rstrip("/")


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: short lineage that outlives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/loomspark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, unless their PYTHONPATH has it already. Once a context."""
    sc = spark.sparkContext
    if str(ROOT) in os.environ.get("PYTHONPATH", "").split(":") or getattr(sc, "_loomspark_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="loomspark-code-")
    path = os.path.join(folder, "loomspark_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((ROOT / "loomspark").rglob("*.py")):
            z.write(f, f.relative_to(ROOT))
        if (pipeline := ROOT / "corpus_pipeline.py").exists():
            z.write(pipeline, pipeline.name)
    sc.addPyFile(path)
    sc._loomspark_shipped = True
