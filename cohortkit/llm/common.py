"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only a local
    master without that setting gets a scratch folder of its own."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        d = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts the
    lineage like a checkpoint, compressed and column-prunable."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` made and nothing reads any more. The driver
    drops the shuffle files of plans that are gone, too, once it has collected them."""
    spark = SparkSession.getActiveSession()
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(1)  # the cleaner works on its own thread


#: glibc's M_MMAP_THRESHOLD and M_TRIM_THRESHOLD; bytes from which a block is on its own.
_MMAP, _TRIM, BLOCK_BYTES = -3, -1, 1 << 22


@functools.cache
def lean() -> None:
    """Called by tasks, works once in a worker: arrays and Arrow buffers of 4 MB or
    more go back to the system when they are freed, instead of staying with a worker
    that waits for its next task. Without glibc nothing changes for arrays."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        mallopt = ctypes.CDLL(None).mallopt
    except (AttributeError, OSError, TypeError):
        return
    mallopt(_MMAP, BLOCK_BYTES)
    mallopt(_TRIM, BLOCK_BYTES)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def remainder(id_col: Column, k: int) -> Column:
    """crc32(id as text) mod k; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(k)


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; bytes.split() and
    bytes.lower() know exactly those ASCII sets."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def hash_words(ws: list[bytes]) -> np.ndarray:
    """64-bit keyed hash of each word, the same in every process."""
    from pandas.util import hash_array

    if not ws:
        return np.empty(0, dtype=np.uint64)
    a = np.empty(len(ws), dtype=object)
    a[:] = ws
    return hash_array(a, categorize=False)


def join_on(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which nulls are equal; ``b``'s keys are dropped."""
    b = b.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__right_{k}"))
    return a.join(b, on, how).drop(*[f"__right_{k}" for k in keys])


def let(x: Column, f) -> Column:
    """f(x) with x evaluated once, also where f uses it inside a lambda."""
    return F.get(F.transform(F.array(x), f), F.lit(0))
