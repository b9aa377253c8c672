"""Token-id files: each document compressed on its own with one shared zstandard dictionary.

A shard is: magic, width of an id in bytes, SHA-256 of the dictionary; one zstandard frame per
document; an index with, for each document, its doc_id, whether that is null, where its frame
starts and how many ids it has; and a footer that says where the index starts. One document is
read with the index and one frame. All numbers are little-endian.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketbars.llm.common import fresh_file, free_names, kind_of, open_folder, slices
from marketbars.llm.encode import encoder
from marketbars.session import having, work_dir

MAGIC = b"IDSZSTD1"
HEAD = struct.Struct("<8sI32s")
FOOT = struct.Struct("<QQQ8s")
INDEX = np.dtype([("doc_id", "<i8"), ("null", "<u1"), ("start", "<u8"), ("ids", "<u8")])
LEVEL = 3
# A shard is closed when it holds this much; a task may write several.
SHARD_BYTES = 256_000_000
# The dictionary is trained on about so many documents, all no longer than this, chosen by hash.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 8192, 65536
READ_BYTES = 16_000_000
# Documents sent to a Python worker at once; by default 10,000, whose texts an executor holds twice.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500
MANIFEST = "place int, seq int, path string, n_docs bigint, n_tokens bigint"


def id_width(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


# --- one shard ---------------------------------------------------------------------------


class ShardWriter:
    def __init__(self, folder: str, stem: str, dictionary: bytes, width: int):
        self.path = fresh_file(folder, stem, "ids")
        system, path = open_folder(self.path)
        self.out = system.open_output_stream(path)
        self.width, self.size, self.ids, self.rows = width, 0, 0, []
        given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=given).compress
        self._put(HEAD.pack(MAGIC, width, hashlib.sha256(dictionary).digest()))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.rows.append((doc_id or 0, doc_id is None, self.size, len(ids)))
        self._put(self.compress(ids.astype(f"<u{self.width}").tobytes()))
        self.ids += len(ids)

    def close(self) -> tuple[str, int, int]:
        start = self.size
        self._put(np.array(self.rows, dtype=INDEX).tobytes())
        self._put(FOOT.pack(start, len(self.rows), self.ids, MAGIC))
        self.out.close()
        return self.path, len(self.rows), self.ids


class ShardReader:
    """Random access to the documents of one shard."""

    def __init__(self, uri: str, dictionary: bytes):
        system, path = open_folder(uri)
        self.file = system.open_input_file(path)
        end = self.file.size() - FOOT.size
        start, rows, self.n_ids, magic = FOOT.unpack(self._at(end, FOOT.size))
        head, self.width, digest = HEAD.unpack(self._at(0, HEAD.size))
        if magic != MAGIC or head != MAGIC:
            raise ValueError(f"{uri} is no finished token-id file")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} was written with another dictionary")
        self.index = np.frombuffer(self._at(start, rows * INDEX.itemsize), dtype=INDEX)
        self.ends = np.append(self.index["start"][1:], start).astype(np.int64)
        given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.decompress = zstandard.ZstdDecompressor(dict_data=given).decompress

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def ids(self, row: int) -> np.ndarray:
        start = int(self.index["start"][row])
        return self._ids(row, self._at(start, int(self.ends[row]) - start))

    def _ids(self, row: int, frame: bytes) -> np.ndarray:
        size = int(self.index["ids"][row]) * self.width
        data = self.decompress(frame, max_output_size=size) if size else b""
        return np.frombuffer(data, dtype=f"<u{self.width}")

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in file order, read in large pieces."""
        starts = self.index["start"].astype(np.int64)
        row = 0
        while row < len(starts):
            last = int(np.searchsorted(self.ends, starts[row] + READ_BYTES, side="right"))
            last = max(last, row + 1)
            data = self._at(int(starts[row]), int(self.ends[last - 1] - starts[row]))
            base = int(starts[row])
            for i in range(row, last):
                doc_id = None if self.index["null"][i] else int(self.index["doc_id"][i])
                yield doc_id, self._ids(i, data[int(starts[i]) - base : int(self.ends[i]) - base])
            row = last


# --- the whole table ---------------------------------------------------------------------


@dataclass(frozen=True)
class TokenFiles:
    """What was written: shards in order, and the dictionary needed to read them."""

    folder: str
    dictionary: bytes
    n_shards: int

    def manifest(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest")


def encode_rows(docs: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """doc_id and ids (little-endian u32) of each document; a null text is empty."""

    def run(batches):
        encode = encoder(tokenizer).encode
        tail = b"" if end_id is None else end_id.to_bytes(4, "little")
        for part in slices(batches):
            ids = [x + tail for x in encode(part.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"]
            )

    kind = kind_of(docs, "doc_id")
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary")


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, width: int) -> bytes:
    """A dictionary from at most about ``SAMPLE_DOCS`` short documents, chosen by hash.

    Bounded whatever the table's size (1,000 arrays of 8 KB at most reach the driver). It
    affects the files' size only, never what is read back. No short document: no dictionary.
    """
    rows = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, rows))
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    short = encode_rows(chosen, tokenizer, end_id).filter(
        F.length("ids") <= SAMPLE_BYTES * 4 // width
    )
    arrays = sorted(
        np.frombuffer(r.ids, "<u4").astype(f"<u{width}").tobytes()
        for r in short.select("ids").limit(2 * SAMPLE_DOCS).collect()
    )
    if not arrays:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except zstandard.ZstdError:  # too little to train on
        return b"".join(arrays)[-DICTIONARY_BYTES:]


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, order: tuple[str, ...] = ()
) -> TokenFiles:
    """Write all documents in ascending order, doc_id by default, null ids last.

    Rows that share a doc_id follow each other by the hash of their text. Rows are dealt by range
    over order, text hash and row number, so that no key, however common, fills one task. A task
    writes under a name of its own and the manifest lists only what finished tasks wrote.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"doc_id must be an integer, not {kind}")
    vocabulary = encoder(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True)
    width = id_width(max(vocabulary, end_id + 1))
    dictionary = train_dictionary(docs, tokenizer, end_id, width)
    tie, row = free_names(docs, "text_hash", "row_number")
    keys = list(order) or ["doc_id"]
    by = [F.col(k).asc_nulls_last() for k in (*keys, tie, row)]
    dealt = (
        docs.select("doc_id", "text", *[k for k in keys if k != "doc_id"])
        .withColumn(tie, F.xxhash64("text"))
        .withColumn(row, F.monotonically_increasing_id())
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select("doc_id", "text")
    )
    shards = f"{folder}/shards"
    system, path = open_folder(shards)
    system.create_dir(path, recursive=True)
    _write(f"{folder}/dictionary", dictionary)

    def run(batches):
        encode = encoder(tokenizer).encode
        place, seq, shard = TaskContext.get().partitionId(), 0, None
        done = []
        tail = end_id.to_bytes(4, "little")
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            ids = part.column("doc_id").to_pylist()
            for doc_id, data in zip(ids, encode(texts), strict=True):
                if shard is None:
                    shard = ShardWriter(shards, f"{place:06d}-{seq:04d}", dictionary, width)
                shard.add(doc_id, np.frombuffer(data + tail, "<u4"))
                if shard.size > SHARD_BYTES:
                    done.append((place, seq, *shard.close()))
                    seq, shard = seq + 1, None
        if shard is not None:
            done.append((place, seq, *shard.close()))
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        columns = list(zip(*done, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            ["place", "seq", "path", "n_docs", "n_tokens"],
        )

    with having(spark, BATCH_SETTING, BATCH_ROWS):
        dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    written = TokenFiles(folder, dictionary, 0)
    return TokenFiles(folder, dictionary, written.manifest(spark).count())


def _write(uri: str, data: bytes) -> None:
    system, path = open_folder(uri)
    with system.open_output_stream(path) as out:
        out.write(data)


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens and the crc32 of its ids.

    ``start`` counts the ids of all documents before it. The sum over shards runs over the
    manifest, which has one row per shard.
    """
    before = W.orderBy("place", "seq").rowsBetween(W.unboundedPreceding, -1)
    shards = (
        files.manifest(spark)
        .withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
        .select("path", "base")
        .repartition(max(1, min(files.n_shards, 20_000)))
    )
    dictionary = files.dictionary

    def run(batches):
        for batch in batches:
            bases = batch.column("base").to_pylist()
            for path, base in zip(batch.column("path").to_pylist(), bases, strict=True):
                rows = []
                at = base
                for doc_id, ids in ShardReader(path, dictionary):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((doc_id, at, len(ids), crc))
                    at += len(ids)
                    if len(rows) == 50_000:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    return shards.mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
    )


def read_documents(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """doc_id and ids of every document, in no order of rows."""
    dictionary = files.dictionary
    shards = files.manifest(spark).select("path")

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held, size = [], 0
                for doc_id, ids in ShardReader(path, dictionary):
                    held.append({"doc_id": doc_id, "ids": ids.astype(np.int64)})
                    size += len(ids)
                    if size > 1_000_000:
                        yield pa.RecordBatch.from_pylist(held, DOCUMENTS)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, DOCUMENTS)

    parts = max(1, min(files.n_shards, 20_000))
    return shards.repartition(parts).mapInArrow(run, "doc_id bigint, ids array<bigint>")


DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])


def token_files(docs: DataFrame, tokenizer: str, end_id: int, order=()) -> DataFrame:
    """Write the documents' token-id files into the shared folder and read them back.

    A null or empty text has the end id alone; repeated rows are written each; an empty table
    gives no shard and no row; other columns are not read. One row per row of ``docs``.
    """
    spark = docs.sparkSession
    files = write_token_files(docs, work_dir(spark, "token-files"), tokenizer, end_id, order)
    return read_token_files(spark, files)
