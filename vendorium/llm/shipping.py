"""Send this package to the Python workers, so that their functions can import it."""

from __future__ import annotations

import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession

BATCH_BYTES = 4 << 20
_PACKAGE = Path(__file__).resolve().parent.parent


@cache
def _archive() -> str:
    """The package's sources as one archive: some tens of kilobytes, made once in a driver process."""
    target = Path(tempfile.mkdtemp()) / f"{_PACKAGE.name}-code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(_PACKAGE.rglob("*.py")):
            archive.write(source, source.relative_to(_PACKAGE.parent))
    return str(target)


@cache
def _sent(application: str, spark: SparkSession) -> None:
    spark.sparkContext.addPyFile(_archive())


def ship(spark: SparkSession) -> None:
    """Spark's own file service hands the archive to every executor, also to those that come later.

    Batches of rows to and from the workers are held to `BATCH_BYTES`: the library's default of 64 MB stands several
    times in the JVM and in Python at once, for each core.
    """
    _sent(spark.sparkContext.applicationId, spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
