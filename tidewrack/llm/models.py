"""Models that are fitted once and kept: in the process, and in the shared checkpoint folder for later runs.

A model is named by a digest of its training rows and of the code that fits it, so that neither other samples nor other
code ever meet a stale one.
"""

from __future__ import annotations

import hashlib
import inspect
import io
from collections.abc import Callable, Iterable
from types import ModuleType

import numpy as np
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from tidewrack.session import ensure_checkpoint_dir

Arrays = dict[str, np.ndarray]
_KEPT: dict[str, Arrays] = {}


def digest(rows: Iterable[object], *code: ModuleType) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode("utf-8", "replace") + b"\x00")
    for m in code:
        h.update(inspect.getsource(m).encode())
    return h.hexdigest()[:32]


def fitted(spark: SparkSession, name: str, key: str, fit: Callable[[], Arrays]) -> Arrays:
    """The arrays of a model: kept ones, stored ones, or fitted and then stored."""
    if key in _KEPT:
        return _KEPT[key]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{name}-{key}"
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        with np.load(io.BytesIO(bytes(spark.read.parquet(path).first().model)), allow_pickle=False) as stored:
            arrays = {k: stored[k] for k in stored.files}
    else:
        arrays = fit()
        held = io.BytesIO()
        np.savez_compressed(held, **arrays)
        try:
            spark.createDataFrame([(bytearray(held.getvalue()),)], "model binary").coalesce(1).write.mode("overwrite").parquet(path)
        except PySparkException:  # another run stores the same model just now
            pass
    _KEPT[key] = arrays
    return arrays
