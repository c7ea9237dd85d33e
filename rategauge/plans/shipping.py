"""The package for Python workers that do not have it installed."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from rategauge.plans.scratch import scratch_path

_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Give the package's files to the workers of this application, once.

    They are put as one archive in the shared folder, from which every executor
    fetches them, those that start later too.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
            for file in sorted(_PACKAGE.rglob("*.py")):
                archive.write(file, f"{_PACKAGE.name}/{file.relative_to(_PACKAGE)}")
        path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, f"{_PACKAGE.name}.zip"))
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        stream = files.create(path, False)
        try:
            stream.write(bytearray(data.getvalue()))
        finally:
            stream.close()
        spark.sparkContext.addPyFile(files.makeQualified(path).toString())
        _shipped.add(application)
    return spark
