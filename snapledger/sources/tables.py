"""Parquet tables by name, and places for data that several jobs share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only where the session names none and runs on one machine (tests) a temporary
    folder is made and set, so that later calls find the same one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        local = tempfile.mkdtemp(prefix="snapledger-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        found = f"file://{local}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/snapledger-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, what: str) -> str:
    return f"{scratch_root(spark)}/{what}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to the shared folder, once its results have been consumed.

    Results are lazy and may read those files, so nothing here is removed by itself.
    """
    remove_tree(spark, scratch_root(spark))


def materialise(df: DataFrame, what: str, by: Sequence[str] = ()) -> DataFrame:
    """Write once to the shared folder and read back: lineage ends in files that outlive executors.

    Filters on the columns ``by`` read only the folders they name.
    """
    spark = df.sparkSession
    path = scratch_path(spark, what)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *jobs: Callable[[], T]) -> list[T]:
    """Results of independent jobs run at the same time, in order: small jobs leave no cores idle while they wait for each other."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def _place(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _place(spark, path)
    return fs.exists(p)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file on any file system Spark can write; it appears whole or not at all."""
    fs, tmp = _place(spark, f"{path}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    _, final = _place(spark, path)
    jvm = spark.sparkContext._jvm
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(tmp, final, over)


def get_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    if not path_exists(spark, path):
        return None
    return "".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())


def remove_tree(spark: SparkSession, path: str) -> None:
    fs, p = _place(spark, path)
    fs.delete(p, True)


def newest_path(spark: SparkSession, folder: str, pattern: str = "*") -> str | None:
    """The entry of a folder that was written last and matches; of equally new ones the highest name."""
    fs, p = _place(spark, f"{folder.rstrip('/')}/{pattern}")
    found = [(s.getModificationTime(), s.getPath().toString()) for s in (fs.globStatus(p) or [])]
    return max(found)[1] if found else None


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, p = _place(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
