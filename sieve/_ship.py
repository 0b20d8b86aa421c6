"""Make the package importable inside Python workers.

Arrow UDFs and ``mapInPandas`` functions are pickled by reference to this
package, so executors need it.  On first use the package is zipped once and
registered with ``SparkContext.addPyFile`` -- the same thing ``--py-files``
does on a cluster.  Already-importable setups pay one cheap check.
"""

from __future__ import annotations

import os
import tempfile
import threading
import zipfile

from pyspark.sql import SparkSession

_lock = threading.Lock()
_shipped: set[int] = set()


def ensure_package(spark: SparkSession | None = None) -> None:
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    key = id(sc)
    if key in _shipped:
        return
    with _lock:
        if key in _shipped:
            return
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg_dir)
        out = os.path.join(tempfile.mkdtemp(prefix="sieve-pkg-"), "sieve.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for d, _, files in os.walk(pkg_dir):
                if "__pycache__" in d:
                    continue
                for f in files:
                    if f.endswith(".py"):
                        p = os.path.join(d, f)
                        z.write(p, os.path.relpath(p, root))
        sc.addPyFile(out)
        _shipped.add(key)
