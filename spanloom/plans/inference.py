"""Windowed inference with a predictor of one's own.

Tokens are cut into overlapping windows, a predictor labels each window, and
the labels become mentions: decode, collapse duplicates, keep what overlaps
nothing better.  Only the predictor is Python.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators import spans

LABELLED = "doc_id long, win int, n int, tok int, ts int, te int, label string"


def windows_of(tokens: DataFrame, size: int, stride: int) -> DataFrame:
    """doc_id, win, n (windows), tok, ts, te: each window's tokens."""
    sizes = tokens.groupBy("doc_id").agg((F.max("tok") + 1).alias("k"))
    cut = sizes.select("doc_id", F.posexplode(spans.token_windows(F.col("k"), size, stride)).alias("win", "w"), F.size(spans.token_windows(F.col("k"), size, stride)).alias("n"))
    return tokens.join(cut, "doc_id").filter("tok >= w.s AND tok < w.e").select("doc_id", "win", "n", "tok", "ts", "te")


def infer(tokens: DataFrame, predict: Callable[[pd.DataFrame], pd.Series], size: int, stride: int, edge: int = 2) -> DataFrame:
    """doc_id, s, e, type: disjoint mentions.

    ``predict`` gets the tokens of one window (tok, ts, te) in order and returns their labels.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("tok").reset_index(drop=True)
        return pdf.assign(label=list(predict(pdf)))

    labelled = windows_of(tokens, size, stride).groupBy("doc_id", "win").applyInPandas(run, LABELLED)
    bounds = labelled.groupBy("doc_id", "win").agg(F.first("n").alias("n"), F.min("ts").alias("ws"), F.max("te").alias("we"), F.min("tok").alias("t0"))
    runs = spans.decode_bio(labelled, ["doc_id", "win"], ["tok"])
    ends = labelled.select("doc_id", "win", "tok", "ts", "te")
    placed = runs.drop("n").join(bounds, ["doc_id", "win"]).withColumn("a", F.col("t0") + F.col("first")).withColumn("b", F.col("t0") + F.col("last"))
    left = ends.select("doc_id", "win", F.col("tok").alias("a"), F.col("ts").alias("s"))
    right = ends.select("doc_id", "win", F.col("tok").alias("b"), F.col("te").alias("e"))
    found = placed.join(left, ["doc_id", "win", "a"]).join(right, ["doc_id", "win", "b"])
    cut = ((F.col("win") > 0) & (F.col("s") <= F.col("ws") + edge)) | ((F.col("win") < F.col("n") - 1) & (F.col("e") >= F.col("we") - edge))
    one = found.withColumn("edge", cut).groupBy("doc_id", "s", "e", "type").agg(F.min("edge").alias("edge"))
    return spans.resolve_overlaps(one, "doc_id", [F.col("edge").cast("int"), F.col("s") - F.col("e"), F.col("s"), F.col("type")], ["s", "e", "type"])
