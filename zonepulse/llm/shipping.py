"""Python code for the executors, which need not have this package installed."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch of rows that Spark hands to Python.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application.

    The archive lies on the driver only; Spark's own file server hands it out.
    """
    sc = spark.sparkContext
    if getattr(sc, "_package_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(root):  # else it was itself imported from an archive on the path
        path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(root)}.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(root):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
    sc._package_shipped = True


def _bound_batches(spark: SparkSession) -> None:
    """Batches on their way to Python end at ``BATCH_BYTES``, not only at a number of rows:
    10,000 long texts would be hundreds of MB in the JVM and again in Python. A lower
    bound that the session has set stays."""
    if _bytes(spark.conf.get(_BATCH)) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def _bytes(text: str) -> int:
    """A size as Spark writes it, such as 1048576, 64m or 64MB."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)b?\s*", text.lower()).groups()
    size = int(number) << 10 * " kmgtp".index(unit or " ")
    return size if size > 0 else 1 << 62


def map_arrow(rows: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package, over batches of bounded bytes."""
    ship(rows.sparkSession)
    _bound_batches(rows.sparkSession)
    return rows.mapInArrow(function, schema)
