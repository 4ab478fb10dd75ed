"""Sending this package to the Python workers.

Workers import the functions that tasks run. Where the package is not installed on the executors, Spark
sends it along: the driver packs it once a session, puts it into the shared folder, and Spark hands it out.
"""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import SparkSession

from ..session import shared_dir

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable in tasks of this session; does nothing the second time."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, name = os.path.split(package)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, files in os.walk(package):
            for file in sorted(files):
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    archive.write(full, os.path.relpath(full, root))
    # Spark has no writer for a single file, so it goes through the file system that Spark itself uses.
    jvm = context._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/{name}-{context.applicationId}-package.zip")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, True)
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(path.toString())
    _SENT.add(context.applicationId)
