"""Line dedup: content-defined chunks of lines find the runs of lines that repeat elsewhere."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import byte_texts, map_slices, slices, stored, text_key
from marketbars.llm.superkmers import order_id
from marketbars.session import work_dir

# Lines the rolling hash looks back on, and its base.
ROLL = 1
BASE = 31
# A chunk goes on behind one line in so many; it ends behind all others.
JOIN = 8
# Lines of a run that is removed, at least.
LEAST_LINES = 2


def line_hash(line: bytes) -> int:
    """32 bits of the line's MD5: spread evenly, and known to SQL engines too."""
    return int.from_bytes(hashlib.md5(line).digest()[:4], "big")


def cuts(lines: list[bytes], roll: int = ROLL, join: int = JOIN) -> list[int]:
    """Where chunks end: behind a line whose rolling hash ``join`` does not divide, and at the end.

    The hash of a line and the ``roll - 1`` before it depends on nothing else, so that lines put
    in or taken out elsewhere leave a chunk's ends alone. Texts have few lines, so chunks are short:
    a run of two lines holds a whole chunk nine times in ten, a longer one nearly always.
    """
    found, rolled, oldest = [], 0, BASE ** (roll - 1)
    hashes = [line_hash(line) for line in lines]
    for i, value in enumerate(hashes):
        if i >= roll:
            rolled -= hashes[i - roll] * oldest
        rolled = rolled * BASE + value
        if rolled % join:
            found.append(i + 1)
    if lines and (not found or found[-1] != len(lines)):
        found.append(len(lines))
    return found


def chunks(text: bytes | None, roll: int, join: int) -> list[tuple[int, int, bytes]]:
    """First line, line behind the last, bytes, of each chunk with a word."""
    if not text:
        return []
    lines = text.split(b"\n")
    out, start = [], 0
    for stop in cuts(lines, roll, join):
        body = b"\n".join(lines[start:stop])
        if body and not body.isspace():
            out.append((start, stop, body))
        start = stop
    return out


def run_around(lines: list[bytes], first: int, other: list[bytes], start: int, stop: int):
    """First line and line behind the last of the run of equal lines around a chunk, or None.

    ``other`` is to be compared with ``lines`` from line ``first`` on. The chunk's own lines are
    compared like all others: an equal hash alone is no copy.
    """
    behind = first + len(other)
    if start < first or stop > behind:
        return None
    if any(lines[i] != other[i - first] for i in range(start, stop)):
        return None
    while start > first and lines[start - 1] == other[start - 1 - first]:
        start -= 1
    while stop < behind and lines[stop] == other[stop - first]:
        stop += 1
    return (start, stop) if stop - start >= LEAST_LINES else None


def _listed(docs: DataFrame, roll: int, join: int) -> DataFrame:
    """id, text_key, lines of the text, first line, line behind, 64-bit hash of every chunk."""

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows, values = [], []
            for i, text in enumerate(byte_texts(part.column("text"))):
                found = chunks(text, roll, join)
                n = text.count(b"\n") + 1 if found else 0
                for start, stop, body in found:
                    rows.append(i)
                    digest = hashlib.blake2b(body, digest_size=8).digest()
                    values.append((n, start, stop, int.from_bytes(digest, "big", signed=True)))
            columns = list(zip(*values, strict=True)) or [[]] * 4
            at = pa.array(rows, pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(at),
                    part.column("text_key").take(at),
                    *[pa.array(c, pa.int64()) for c in columns],
                ],
                ["id", "text_key", "n_lines", "start", "stop", "hash"],
            )

        return step

    return map_slices(
        docs.select("id", "text_key", "text"),
        make,
        "id bigint, text_key bigint, n_lines bigint, start bigint, stop bigint, hash bigint",
    )


def _answers(asked: DataFrame) -> DataFrame:
    """Of every text asked, the lines that lie where the asking text has lines."""

    def run(batches):
        for part in slices(batches):
            out = []
            columns = (
                part.column(c).to_pylist()
                for c in ("of_id", "of_key", "shift", "n_lines", "starts", "stops")
            )
            for text, *of, shift, n, starts, stops in zip(
                byte_texts(part.column("text")), *columns, strict=True
            ):
                lines = text.split(b"\n")
                low, high = max(0, -shift), min(len(lines), n - shift)
                body = b"\n".join(lines[low:high])
                out.append((*of, low + shift, body, starts, stops))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            many = pa.list_(pa.int64())
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), many, many)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["id", "text_key", "first", "body", "starts", "stops"],
            )

    return asked.mapInArrow(
        run,
        "id bigint, text_key bigint, first bigint, body binary, starts array<bigint>, "
        "stops array<bigint>",
    )


def _without(joined: DataFrame, kind: str) -> DataFrame:
    def one(text: bytes | None, met: list[dict] | None):
        if text is None:
            return None, 0, 0, []
        lines = text.split(b"\n")
        if not met:
            return text, len(lines), 0, []
        gone = set()
        for m in met:
            other = m["body"].split(b"\n")
            done = m["first"]
            for start, stop in sorted(zip(m["starts"], m["stops"], strict=True)):
                # Chunks of one run lead to the same run.
                if start >= done and (found := run_around(lines, m["first"], other, start, stop)):
                    gone.update(range(*found))
                    done = found[1]
        kept = [line for i, line in enumerate(lines) if i not in gone]
        return b"\n".join(kept), len(lines), len(gone), sorted(gone)

    def run(batches):
        for part in slices(batches):
            texts, met = byte_texts(part.column("text")), part.column("met").to_pylist()
            rows = [one(*x) for x in zip(texts, met, strict=True)]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ],
                ["doc_id", "kept_text", "n_lines", "n_removed", "removed"],
            )

    return joined.select("doc_id", "text", "met").mapInArrow(
        run,
        f"doc_id {kind}, kept_text string, n_lines bigint, n_removed bigint, removed array<int>",
    )


def dedup_lines(docs: DataFrame, roll: int = ROLL, join: int = JOIN) -> DataFrame:
    """doc_id, kept_text, n_lines, n_removed and removed line numbers of every row of ``docs``.

    Texts are cut into chunks of lines where a rolling hash of line hashes says so. The first copy
    of a chunk with any word in it is the one with the smallest doc_id (then the least text hash,
    then the first line). Around every other copy, the text is compared with the first one's, line
    by line in both directions, byte by byte; the run of equal lines goes if it has two lines or
    more, in repeats inside one text too. What is asked of the first copy's text are the lines
    that can lie beside those of the asking text, once however many chunks lie in a row. All is
    judged on the input: every line that goes stays somewhere at a smaller place.

    Kept lines are joined as they were; a text whose lines all go becomes empty. A null text
    stays null and has no lines; an empty one has one. A null doc_id counts as larger than any.
    Rows equal in id and text count as one document and get the same result. An empty table gives
    no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "line-chunks")
    keyed = docs.select("doc_id", order_id().alias("id"), text_key().alias("text_key"), "text")
    keys = ["id", "text_key"]
    rows = stored(_listed(keyed, roll, join), f"{folder}/all")
    place = F.struct("id", "text_key", "start")
    # Rows equal in id and text have equal chunks at equal places: those are no copies.
    met = rows.groupBy("hash").agg(F.min(place).alias("at"), F.max(place).alias("last"))
    met = stored(met.filter("at <> last").select("hash", "at"), f"{folder}/met")
    late = rows.join(met, "hash").filter(place != F.col("at"))
    # Once for all chunks that lie at the same distance from their copies in the same text.
    asked = late.groupBy(
        F.col("at.id").alias("id"),
        F.col("at.text_key").alias("text_key"),
        F.col("id").alias("of_id"),
        F.col("text_key").alias("of_key"),
        (F.col("start") - F.col("at.start")).alias("shift"),
    ).agg(
        F.max("n_lines").alias("n_lines"),
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("found"),
    )
    asked = asked.select(
        *keys, "of_id", "of_key", "shift", "n_lines", "found.start", "found.stop"
    ).withColumnsRenamed({"start": "starts", "stop": "stops"})
    asked = stored(asked, f"{folder}/asked")
    # Of rows equal in id and text, one text answers. Written, so that a join of its own can split
    # what many copies ask of one text.
    texts = keyed.select(*keys, "text").join(asked.select(*keys).distinct(), keys, "left_semi")
    texts = stored(texts.dropDuplicates(keys), f"{folder}/texts")
    answers = _answers(asked.join(texts, keys))
    found = F.struct("first", "body", "starts", "stops")
    met = answers.groupBy(*keys).agg(F.collect_list(found).alias("met"))
    return _without(keyed.join(met, keys, "left"), docs.schema["doc_id"].dataType.simpleString())
