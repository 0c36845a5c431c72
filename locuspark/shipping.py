"""Make the package importable in Spark's Python workers, wherever they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED = "_locuspark_shipped"


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, _SHIPPED, False):
        return
    home = Path(__file__).resolve().parent
    if home.parent.is_dir():  # else the package was itself imported from a shipped archive
        archive = Path(tempfile.mkdtemp(prefix="locuspark-")) / "locuspark.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(home.rglob("*.py")):
                out.write(file, file.relative_to(home.parent))
        context.addPyFile(str(archive))
    setattr(context, _SHIPPED, True)
