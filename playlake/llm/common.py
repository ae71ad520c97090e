"""Helpers the corpus operators share: narrow document frames, written tables, Arrow columns.

Conventions of every operator here, unless its docstring says otherwise: ``doc_id`` may be
null or repeated, a null text counts as empty, other columns of the input are ignored (so
their names cannot clash), an empty input gives an empty result with the usual columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from playlake.session import scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns every operator reads: ``doc_id`` as bigint, ``text`` with null as empty."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the session's shared folder: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def utf8(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8 byte strings, null as empty."""
    wide = pa.types.is_large_string(column.type)
    return [v or b"" for v in column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], size: int) -> Iterable[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows, so that what a step holds in memory is bounded."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def whole_groups(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Batches of rows sorted by the long columns ``names`` -> tables that hold whole groups."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(n).to_numpy() for n in names])
        if held and (keys[0] != [held[-1].column(n)[held[-1].num_rows - 1].as_py() for n in names]).any():
            yield pa.Table.from_batches(held)
            held = []
        cut = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1] + 1) if (keys[0] != keys[-1]).any() else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)
