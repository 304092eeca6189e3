"""What the operators of this subpackage share: tables, words, the shared folder.

Nothing here keeps state on one machine.  Whatever has to outlive a job goes to
the folder that the session names in ``spark.checkpoint.dir``; only where that
is unset and all runs on one machine (tests, a laptop) a temporary folder is made
and put into the session.  On a cluster an unset folder is an error.
"""

from __future__ import annotations

import functools
import gc
import tempfile
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space between words: blank and U+0009 to U+000D, nothing else.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def full_text(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def plain_id(column: str = "doc_id") -> tuple[Column, Column]:
    """(the id, 0 for null; whether it is null).  A column of longs with a null in it reaches
    pandas as floating point, which rounds ids beyond 2 ** 53."""
    return F.coalesce(F.col(column).cast("long"), F.lit(0)).alias(column), F.col(column).cast("long").isNull().alias("no_id")


def own_id(column: str = "doc_id") -> Column:
    """Undoes ``plain_id``."""
    return F.when(~F.col("no_id"), F.col(column)).alias(column)


def long_array(values: list[int | None]) -> pd.api.extensions.ExtensionArray:
    """Exact longs, some of them null."""
    return pd.array(values, dtype="Int64")


def word_array(text: Column) -> Column:
    """Runs of characters other than blank and U+0009 to U+000D, unchanged.

    Texts whose only white space is the blank, as in most lines, are split without a pattern.
    """
    words = F.when(text.rlike("[\\x09-\\x0D]"), F.split(text, SPACE_CLASS)).otherwise(F.split(text, " "))
    return F.array_remove(words, "")


def on_plain_names(own: tuple[str, ...]):
    """For functions that return rows of their first argument, with its columns: inside,
    columns other than ``own`` have names that clash with none."""

    def wrap(f):
        @functools.wraps(f)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            plain = docs.toDF(*(c if c in own and docs.columns.index(c) == i else f"__x{i}" for i, c in enumerate(docs.columns)))
            return f(plain, *args, **kwargs).toDF(*docs.columns)

        return run

    return wrap


def shared_dir(spark: SparkSession) -> str:
    """URI of a fresh folder that driver and executors all see."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = "file://" + tempfile.mkdtemp(prefix="spanloom-")
        spark.conf.set("spark.checkpoint.dir", top)
    if "://" not in top and not top.startswith("file:"):
        top = "file://" + top
    return f"{top.rstrip('/')}/llm-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    It cuts the lineage, so a lost executor costs no earlier step, and lets
    Spark drop the shuffle files of the steps before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    del df
    release(spark)
    return spark.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Frees shuffle files that no live plan needs any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
