"""Small helpers shared by the text operators.

Functions that run in Python workers are pickled by value (:func:`ship`), so a
worker needs no copy of this package on its path.  :func:`worker_object` keeps
an expensive object (a vocabulary, a bounded cache) for the life of the worker
process instead of rebuilding it for every task.
"""

import os
import sys

import pyspark
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of the public tokenizer files; a parameter of every operator that reads one.
TOKENIZERS = "/opt/tokenizers"


def ship(module_name: str) -> None:
    """Pickle this module's functions by value when they are sent to workers."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def worker_object(key, build):
    """``build()`` once per Python process; later calls with ``key`` reuse the object."""
    store = pyspark.__dict__.setdefault("_stratus_worker_objects", {})
    if key not in store:
        store[key] = build()
    return store[key]


#: Most rows and bytes of texts that a Python worker holds at a time.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches bounded for whole texts.

    The default of 10,000 rows and 64 MB a batch leaves each Python worker with several hundred
    megabytes that it never returns.  Smaller settings of the session stay.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(key).lower().rstrip("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            conf.set(key, str(most))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str, folder: str = TOKENIZERS) -> str:
    return os.path.join(folder, name)


def text_or_empty(col) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def null_safe_key(col) -> Column:
    """A string key that keeps NULL apart from every value, usable in an equi-join."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name not in ``df`` (callers' tables may hold any extra columns)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
