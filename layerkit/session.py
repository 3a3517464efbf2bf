"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def local_session(cores: int | str = "*", app: str = "layerkit", **conf: str) -> SparkSession:
    """Session for tests and single-machine runs. On a cluster the submitter's own
    settings apply and this function is not used."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Have Spark send this package to the Python workers, so that they can import it wherever the
    session was started; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="layerkit-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`. What is put there is
    not deleted by this library; `new_path` names tell the step they belong to."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def store(df: DataFrame, label: str) -> DataFrame:
    """`df` written once below the shared folder and read again."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def few_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """DataFrame of rows the driver already holds, planned as a local relation."""
    layout = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [[] for _ in layout]
    arrays = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, layout)]
    return spark.createDataFrame(pa.table(arrays, names=layout.names), layout)
