"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: What separates words: space and \\x09-\\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: later steps start from the files.

    Lost executors then cost a read, not the steps before, and joins see
    plain scans whose skewed partitions AQE can split.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key() -> list[Column]:
    """128 bits that stand for a text: equal texts have equal keys."""
    return [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(7), "text", F.octet_length("text")).alias("k2")]


def packed(df: DataFrame, text: str = "text") -> DataFrame:
    """Whole rows as one struct ``row`` beside their ``text``: added columns can't clash with the table's own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))


def arrays(schema: list[tuple[str, pa.DataType]], **columns) -> pa.RecordBatch:
    """A record batch of the named columns, cast to the given types."""
    out = []
    for name, kind in schema:
        x = columns[name]
        out.append(x if isinstance(x, (pa.Array, pa.StructArray)) else pa.array(x, kind))
    return pa.RecordBatch.from_arrays(out, names=[n for n, _ in schema])


def mapped(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema, columns: str | tuple[str, ...] = "text") -> DataFrame:
    """``mapInArrow`` over slices of bounded text size."""
    from tidemark.llm.textscan import arrow_map

    return df.mapInArrow(arrow_map(fn, columns), schema)
