"""What the operators share: words, bounded slices of batches, names, ids and files."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text bytes that a task works on at once; one longer document is a slice of its own.
SLICE_BYTES = 2_000_000


def words(text: bytes | None) -> list[bytes]:
    """Runs of bytes other than space and TAB..CR: what ``bytes.split`` cuts out."""
    return text.split() if text else []


def byte_texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``SLICE_BYTES`` of text, or one document."""
    for batch in batches:
        start, held = 0, 0
        lengths = pc.binary_length(batch.column(text).cast(pa.binary())).to_pylist()
        for row, length in enumerate(lengths):
            if held and held + (length or 0) > SLICE_BYTES:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def map_slices(
    docs: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str
) -> DataFrame:
    """``make()`` is called once in each task; what it returns maps slice after slice."""

    def run(batches):
        step = make()
        for part in slices(batches):
            yield step(part)

    return docs.mapInArrow(run, schema)


def kind_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, lengthened where the frame has such a column already."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def text_key() -> Column:
    """Tells rows apart that share a doc_id but not a text."""
    return F.xxhash64("text")


def stored(df: DataFrame, folder: str) -> DataFrame:
    """Written to the shared folder and read again.

    Cuts the lineage. An aggregate that is stored joins through a shuffle of its own, so that
    adaptive execution can split the other side's partitions where one key has most of the rows.
    """
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# --- files in the shared folder ----------------------------------------------------------


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def fresh_file(uri: str, stem: str, ending: str) -> str:
    """A file name no other attempt of the same task uses."""
    return f"{uri}/{stem}-{uuid.uuid4().hex}.{ending}"
