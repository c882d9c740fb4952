"""Pieces shared by the training-data operators: inputs, folds, shared scratch tables."""
from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

HELD_OUT = 2  # remainder of crc32(doc_id) mod 4 whose rows no model may learn from
BLOCK_CHARS = 2_000_000  # texts are handled in blocks of about this many characters


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2 (a null id counts as held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(True))


class Scratch:
    """Intermediate tables of one job, written under the shared checkpoint folder.

    A written table cuts the lineage: a lost executor costs the tasks it ran, not
    the stages before.  ``drop`` deletes tables that no returned frame reads."""

    def __init__(self, spark: SparkSession, job: str):
        self.spark = spark
        self.root = scratch_path(spark, f"{job}-{uuid.uuid4().hex}")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


def numbered(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """The rows of ``docs`` with a number of their own, written so that every read sees the same, and the number's
    column, whose name no column of ``docs`` has."""
    name = "_row_key"
    while name in docs.columns:
        name += "_"
    return scratch.keep(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def text_blocks(batches: Iterable[pa.RecordBatch], text: str = "text",
                chars: int = BLOCK_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut Arrow batches into runs of rows of about ``chars`` characters (one row at
    least), with the texts as Python strings, so that memory follows the longest
    text and not the batch."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        block = np.cumsum(sizes) // chars
        edges = np.flatnonzero(np.diff(block, prepend=-1)) if len(block) else []
        for a, b in zip(edges, [*edges[1:], batch.num_rows]):
            part = batch.slice(a, b - a)
            yield part, part.column(part.schema.get_field_index(text)).to_pylist()
