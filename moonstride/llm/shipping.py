"""Makes this library importable in the Python workers of a session."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import SparkSession

from moonstride.session import scratch_path

_SHIPPED: set[str] = set()
ARROW_BATCH_BYTES = 8 << 20


def ship_library(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once; needed where it is not installed on the executors.

    Also keeps what goes to a Python worker at a time to ``ARROW_BATCH_BYTES``, so long texts do not pile up.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package, packed = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    path = scratch_path(spark, "library") + ".zip"
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(place) as out:
        out.write(packed.getvalue())
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
