"""Makes this package importable in the Python workers of any cluster."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the library's source to the workers, once in an application.

    Spark hands the archive from the driver to every executor, so nothing has to
    be installed there and no folder is shared.
    """
    app = spark.sparkContext.applicationId
    if app not in _sent:
        library = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="orrery-source-")) / "orrery_source.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(library.rglob("*.py")):
                out.write(path, path.relative_to(library.parent))
        spark.sparkContext.addPyFile(str(archive))
        _sent.add(app)
    return spark
