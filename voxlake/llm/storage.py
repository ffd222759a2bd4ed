"""What operators need of a cluster: tables in the shared folder, and this package on executors."""

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from voxlake.settings import shared_folder

_shipped: set[str] = set()  # applications that have the package
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)  # paths of the open scratch


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors, which need not have it installed. Once a session."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = Path(__file__).resolve().parents[1]
        file = Path(tempfile.mkdtemp(prefix="run-")) / f"{root.name}.zip"  # the driver serves it
        with zipfile.ZipFile(file, "w") as archive:
            for source in root.rglob("*.py"):
                archive.write(source, source.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(file))
        _shipped.add(application)


def kept(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written below spark.checkpoint.dir and read again: lineage ends here.

    A lost executor costs the tasks that read from it, never a second run of what came before.
    """
    path = shared_folder(rows.sparkSession, purpose)
    _own(path)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _own(path: str) -> None:
    paths = _owned.get()
    if paths is not None:
        paths.append(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What `kept` writes inside the block is deleted at its end, also after an error.

    Rows built from it have to be written, or counted, before that. Without a scratch around them
    tables stay below spark.checkpoint.dir, for results are read from them after an operator returns.
    """
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def finished(spark: SparkSession, build: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """What build returns, kept; the tables it made on the way are deleted once that is written.

    The kept table belongs to the scratch around the call, if there is one.
    """
    path = shared_folder(spark, purpose)
    _own(path)
    with scratch(spark):
        rows = build()
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
