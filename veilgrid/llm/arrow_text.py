"""Arrow batches of rows with a text as Python values, a bounded slice at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text held as Python strings at once.
SLICE_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``SLICE_BYTES`` in these columns (``text``); one row may be larger, and then stands alone."""
    for batch in batches:
        sizes = sum(pc.fill_null(pc.binary_length(column(batch, c)), 0).to_numpy(zero_copy_only=False).astype("int64") for c in columns or ("text",))
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def with_texts(docs: DataFrame, change: Callable[[list[str]], list[str]], text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with ``change`` of their texts (null: empty) in place of them, and their lengths in ``length_col``; all
    other columns pass through the worker as they are, so nothing is joined or shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = pa.array(change(pc.fill_null(column(batch, text_col), "").to_pylist()), column(batch, text_col).type)
            batch = batch.set_column(batch.schema.get_field_index(text_col), text_col, texts)
            if length_col is not None:
                batch = batch.set_column(batch.schema.get_field_index(length_col), length_col, pc.utf8_length(texts).cast(pa.int64()))
            yield batch

    if length_col is not None:
        docs = docs.withColumn(length_col, F.col(length_col).cast("long"))
    return docs.mapInArrow(run, docs.schema)
