"""Token counts of flat token files without an index, by a scan for the end identifier."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketbars.llm.common import fresh_file, kind_of, open_folder, slices
from marketbars.llm.encode import encoder
from marketbars.llm.tokenfile import id_width
from marketbars.session import ensure_checkpoint_dir, work_dir

# Ids of one block; a block is what one step of a task reads.
BLOCK_IDS = 4_000_000


def width_of(tokenizer: str, end_id: int) -> int:
    """Bytes that hold every id of the tokenizer, and the end."""
    vocabulary = encoder(tokenizer, special_as_text=True).tokenizer.get_vocab()
    return id_width(max(*vocabulary.values(), end_id) + 1)


def flat_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, width: int | None = None
) -> DataFrame:
    """Write ids of whole documents one after the other, each ended by ``end_id``.

    An id takes ``width`` bytes: as many as the vocabulary needs, unless it is given. An id that
    does not fit is an error.

    Returns, apart from the files, which document is the how-manieth of which file. Special
    strings in a text are ordinary text, so that ``end_id`` stands for ends alone.
    """
    spark = docs.sparkSession
    width = width or width_of(tokenizer, end_id)
    most = (1 << 8 * width) - 1
    parts = f"{folder}/flat"
    system, path = open_folder(parts)
    system.create_dir(path, recursive=True)

    def run(batches):
        encode = encoder(tokenizer, special_as_text=True).encode
        name, out, at = None, None, 0
        for part in slices(batches):
            if out is None:
                name = fresh_file(parts, f"{TaskContext.get().partitionId():06d}", "bin")
                system, path = open_folder(name)
                out = system.open_output_stream(path)
            for data in encode(part.column("text").to_pylist()):
                ids = np.append(np.frombuffer(data, "<u4"), end_id)
                if ids.max() > most:
                    raise ValueError(f"id {ids.max()} does not fit {width} bytes")
                out.write(ids.astype(f"<u{width}").tobytes())
            rows = np.arange(at, at + part.num_rows)
            at += part.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(rows)), pa.array(rows), part.column("doc_id")],
                ["file", "ordinal", "doc_id"],
            )
        if out is not None:
            out.close()

    kind = kind_of(docs, "doc_id")
    schema = f"file string, ordinal bigint, doc_id {kind}"
    docs.select("doc_id", "text").mapInArrow(run, schema).write.parquet(f"{folder}/order")
    return spark.read.schema(schema).parquet(f"{folder}/order")


def blocks(files: DataFrame, width: int, block_ids: int) -> DataFrame:
    """File, first id and number of ids of every block of the named files."""

    def run(batches):
        for batch in batches:
            rows = []
            for name in batch.column("file").to_pylist():
                system, path = open_folder(name)
                size = system.get_file_info(path).size
                if size % width:
                    raise ValueError(f"{name} is no whole number of {width}-byte ids")
                n = size // width
                rows += [(name, s, min(block_ids, n - s), n) for s in range(0, n, block_ids)]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["file", "first", "n_ids", "file_ids"],
            )

    return files.select("file").mapInArrow(
        run, "file string, first bigint, n_ids bigint, file_ids bigint"
    )


def scan(found: DataFrame, end_id: int, width: int) -> DataFrame:
    """Every separator: its block, its rank there, its place, the separator before it there.

    One block is read and searched as an array. The separator before the first of a block is not
    known there and stays null.
    """

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                system, path = open_folder(row["file"])
                with system.open_input_file(path) as source:
                    source.seek(row["first"] * width)
                    data = source.read(row["n_ids"] * width)
                at = np.flatnonzero(np.frombuffer(data, f"<u{width}") == end_id) + row["first"]
                before = pa.array([None, *at[:-1].tolist()] if len(at) else [], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]] * len(at), pa.string()),
                        pa.array(np.full(len(at), row["first"], np.int64)),
                        pa.array(np.arange(len(at))),
                        pa.array(at),
                        before,
                    ],
                    ["file", "first", "rank", "ends_at", "before"],
                )

    return found.select("file", "first", "n_ids").mapInArrow(
        run, "file string, first bigint, rank bigint, ends_at bigint, before bigint"
    )


def token_counts(
    files: DataFrame, end_id: int, width: int = 2, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """One row per document of the flat files in column ``file``: place, start and token count.

    Blocks are scanned apart. A prefix scan over the blocks that hold a separator (their number,
    and the place of the last one) then gives each block the documents before it and where its
    first document began, maybe many blocks earlier. ``n_tokens`` leaves the end id out. Ids
    behind a file's last separator are a document with ``ended`` false. Empty files have none;
    a file named twice is read once; null names are left out.
    """
    names = files.select("file").filter("file IS NOT NULL").distinct()
    spark = files.sparkSession
    ensure_checkpoint_dir(spark)
    listed = blocks(names, width, block_ids).checkpoint()
    # As many tasks as blocks, as far as sensible; more are then read one after the other.
    n = max(1, min(listed.count(), 20_000))
    separators = scan(listed.repartition(n), end_id, width)
    folder = work_dir(spark, "separators")
    separators.write.parquet(folder)
    separators = spark.read.parquet(folder)
    held = separators.groupBy("file", "first").agg(
        F.count("*").alias("held"), F.max("ends_at").alias("last")
    )
    earlier = W.partitionBy("file").orderBy("first").rowsBetween(W.unboundedPreceding, -1)
    carried = held.select(
        "file",
        "first",
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("documents"),
        F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("carried"),
    )
    start = F.coalesce("before", "carried") + 1
    ended = separators.join(carried, ["file", "first"]).select(
        "file",
        (F.col("documents") + F.col("rank")).alias("ordinal"),
        start.alias("start"),
        (F.col("ends_at") - start).alias("n_tokens"),
        F.lit(True).alias("ended"),
    )
    totals = held.groupBy("file").agg(F.sum("held").alias("held"), F.max("last").alias("last"))
    rest = F.col("file_ids") - F.coalesce("last", F.lit(-1)) - 1
    open_ends = (
        listed.groupBy("file")
        .agg(F.max("file_ids").alias("file_ids"))
        .join(totals, "file", "left")
        .filter(rest > 0)
        .select(
            "file",
            F.coalesce("held", F.lit(0)).alias("ordinal"),
            (F.coalesce("last", F.lit(-1)) + 1).alias("start"),
            rest.alias("n_tokens"),
            F.lit(False).alias("ended"),
        )
    )
    return ended.unionByName(open_ends)


def document_token_counts(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Documents written to flat files, counted there, and named again by their place.

    One row per row of ``docs``: doc_id, n_tokens. A null or empty text has 0 tokens; an empty
    table gives no row; other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    width = width_of(tokenizer, end_id)
    order = flat_files(docs, work_dir(spark, "flat-tokens"), tokenizer, end_id, width)
    counted = token_counts(order, end_id, width)
    return order.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens", "start", "ended")
