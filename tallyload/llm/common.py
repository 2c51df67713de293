"""Small helpers shared by the operators: input selection and written intermediate tables."""

from __future__ import annotations

import contextlib
import sys
import types
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyload.session import ensure_checkpoint_dir

#: Words of every contract: runs of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def crc32_mod(col: Column, n: int) -> Column:
    """Remainder of the CRC-32 of a key written as text, the rule for held-out rows."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(n)


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Project to the named columns only, so that extra or clashing input columns never matter."""
    return df.select(*[F.col(f"`{src}`").alias(name) for name, src in cols.items()])


class Scratch:
    """Intermediate tables of one operator run, written below ``spark.checkpoint.dir``.

    A table that is written and read again cuts the lineage: losing an executor
    costs its running tasks only, never the work of earlier steps.
    """

    def __init__(self, spark: SparkSession, name: str):
        base = ensure_checkpoint_dir(spark).rstrip("/")
        self.spark, self.root = spark, f"{base}/tallyload-{name}-{uuid.uuid4().hex[:12]}"
        for kept in _scopes:
            kept.append(self)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Delete a table that no later step reads, or all of them."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_scopes: list[list[Scratch]] = []


@contextlib.contextmanager
def dropped_after() -> Iterator[None]:
    """Deletes, at its end, all intermediate tables that operators began inside it; their results must be written by then."""
    _scopes.append(opened := [])
    try:
        yield
    finally:
        _scopes.remove(opened)
        for scratch in opened:
            scratch.drop()


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column of ``taken`` has it."""
    lower = {c.lower() for c in taken}
    while name in lower:
        name = f"_{name}"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_cache(key, make):
    """An object kept by a Python worker across its tasks; it must give the same results when made anew."""
    holder = sys.modules.setdefault("tallyload_llm_worker_cache", types.ModuleType("tallyload_llm_worker_cache"))
    kept = holder.__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
