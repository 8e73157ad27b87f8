"""The library's code for Python workers that cannot import it from their own path."""

import io
import zipfile
from pathlib import Path
from tempfile import TemporaryDirectory

from pyspark.sql import SparkSession

_shipped: dict[str, TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Adds the package to the session's Python files, once per application.

    Spark serves the archive, of some ten KB, from the driver; workers on other machines or with
    another working folder can then import the modules that tasks name.
    """
    application = spark.sparkContext.applicationId
    package = Path(__file__).resolve().parent.parent
    if application in _shipped or not package.is_dir():
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    _shipped[application] = TemporaryDirectory(prefix="package-", ignore_cleanup_errors=True)
    target = Path(_shipped[application].name, f"{package.name}.zip")
    target.write_bytes(data.getvalue())
    spark.sparkContext.addPyFile(str(target))
