"""versica: a Spark-native analytics engine for large text collections."""

from __future__ import annotations

import os
import tempfile
import zipfile

_SHIPPED: set[str] = set()


def ship(spark) -> None:
    """Send this package to the Python workers, once for each application, so that they need no path of the driver's."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="versica-"), "versica.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(root)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
