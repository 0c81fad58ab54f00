"""Intermediate tables in the shared folder that the cluster names in `spark.checkpoint.dir`."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repopulse.llm.textops import mix


def shared_root(spark: SparkSession) -> str:
    """The session's shared folder. Where none is set, a local session gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="repopulse-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, and safe from the loss
    of executors. The folder belongs to the run; a cluster clears it with its checkpoints."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/repopulse-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


FILTER_BITS = 23


class IdFilter:
    """A bitmap of ids of fixed size: it holds every id it was made of, and a few others.

    It keeps rows out of a shuffle that an exact join after it would drop anyway. The number of
    bits is fixed, so it may be broadcast; with very many ids it passes more rows, not fewer.
    """

    def __init__(self, ids: DataFrame, bits: int = FILTER_BITS):
        """`ids` has one column of longs; nulls do not count."""
        mask = np.uint64((1 << bits) - 1)

        def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = np.unique(mix(batch.column(0).to_numpy().view(np.uint64)) & mask).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(found)], names=["slot"])

        known = ids.select(F.col(ids.columns[0]).cast("long").alias("id")).where("id is not null")
        found = known.mapInArrow(slots, "slot int").distinct().toArrow()["slot"].to_numpy()
        flags = np.zeros(1 << bits, bool)
        flags[found] = True
        self._mask = mask
        self._flags = ids.sparkSession.sparkContext.broadcast(np.packbits(flags, bitorder="little"))

    def holds(self, ids: np.ndarray) -> np.ndarray:
        slot = mix(ids.astype(np.int64, copy=False).view(np.uint64)) & self._mask
        flags = self._flags.value[(slot >> np.uint64(3)).astype(np.int64)]
        return (flags >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def among(self, ids: pa.Array) -> np.ndarray:
        """True where an id (long) may be among those; false for null."""
        held = self.holds(ids.fill_null(0).to_numpy(zero_copy_only=False))
        return held & ids.is_valid().to_numpy(zero_copy_only=False)

    def __getstate__(self):
        return {"_mask": self._mask, "_flags": self._flags}

    def column(self, id_column: Column) -> Column:
        """True where an id may be among those; false for null."""
        held = self

        @F.pandas_udf("boolean")
        def may_hold(ids: pd.Series) -> pd.Series:
            null = ids.isna().to_numpy()
            return pd.Series(held.holds(ids.fillna(0).to_numpy(np.int64)) & ~null)

        return may_hold(id_column.cast("long"))


def without(docs: DataFrame, dropped: DataFrame, repeated: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """Rows of `docs` whose id is not among the `dropped` ones (one column); all columns stay.

    Rows with a null id stay. Of the rows of each id in `repeated`, one stays, with the least text.
    Only rows that the bitmap holds are shuffled, so clean documents stay where they are.
    """
    ids = dropped.toDF("_id")
    listed = ids if repeated is None else ids.unionByName(repeated.toDF("_id"))
    rows = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_key"))
    held = IdFilter(listed).column(F.col("_key"))
    rows = rows.withColumn("_held", held)
    sure = rows.where("not _held or _held is null").select("_row")
    held_rows = rows.where("_held").join(ids.distinct(), F.col("_key") == F.col("_id"), "left_anti")
    if repeated is not None:
        again = repeated.toDF("_again").distinct()
        held_rows = held_rows.join(again, F.col("_key") == F.col("_again"), "left")
        first = Window.partitionBy("_again").orderBy(F.col("_row.text"))
        doubled = held_rows.where("_again is not null").withColumn("_n", F.row_number().over(first)).where("_n = 1")
        held_rows = held_rows.where("_again is null").select("_row").unionByName(doubled.select("_row"))
    return sure.unionByName(held_rows.select("_row")).select("_row.*")
