"""Substring dedup: windows of words travel as super-k-mers and are counted by sorting."""

from __future__ import annotations

import hashlib
import itertools
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from marketbars.llm.common import byte_texts, map_slices, slices, stored, text_key
from marketbars.session import work_dir

WINDOW = 50
# Words of a minimiser.
MINIMISER = 8
# Super-k-mers a bucket may have to be sorted in one piece of one task.
BUCKET = 1000
# Super-k-mers sorted together: whole buckets up to about so many.
CHUNK = 20_000
DIGEST = ["high", "low"]
PLACES = "array<struct<first: int, last: int>>"
# Stands for a null id: not smaller than any other.
LAST = (1 << 63) - 1


def digest(words: bytes) -> bytes:
    """128 bits of a cryptographic hash: equal only for equal words."""
    return hashlib.blake2b(words, digest_size=16).digest()


def order_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST))


# --- which windows share a minimiser -----------------------------------------------------


def minimisers(hashes: np.ndarray, ends: np.ndarray, window: int, size: int):
    """Runs of windows with the same leftmost least ``size``-word hash, over all documents.

    ``hashes`` are word hashes of documents one after the other, ``ends`` their cumulative
    lengths. Returns minimiser, document, first window, number of windows, place of the
    minimiser's first word in the first window.
    """
    mixed = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for i in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(mixed)]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    least, place = mixed, np.arange(len(mixed))
    covered, span = 1, window - size + 1
    while covered < span:
        step = min(covered, span - covered)
        later = least[step:] < least[:-step] if len(least) > step else np.zeros(0, bool)
        n = len(later)
        least = np.where(later, least[step:], least[:n])
        place = np.where(later, place[step:], place[:n])
        covered += step
    starts = np.concatenate(([0], ends[:-1]))
    valid = np.zeros(len(place) + 1, bool)
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        valid[a : max(a, b - window + 1)] = True
    at = np.flatnonzero(valid[: len(place)])
    where = place[at]
    heads = np.flatnonzero(np.append(True, where[1:] != where[:-1])) if len(at) else at
    first = at[heads]
    document = np.searchsorted(ends, first, side="right")
    count = np.diff(np.append(heads, len(at)))
    return (
        mixed[where[heads]].view(np.int64),
        document,
        first - starts[document],
        count,
        where[heads] - first,
    )


def super_kmers(docs: DataFrame, window: int = WINDOW, size: int = MINIMISER) -> DataFrame:
    """id, text_key, minimiser, run (places of its first window, number, lead) of every different
    super-k-mer of a text, and the 128-bit hash of its words in two halves.

    Where a text goes round in few words, one super-k-mer comes hundreds of times: it is one row
    with all its places, in rising order. Places that follow each other by at most a window are
    held as one, by their first and last: any window of theirs covers all words between.
    """

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            numbers: dict[bytes, int] = {}
            number = numbers.setdefault
            ids, lengths, joined, places = [], [], [], []
            for text in byte_texts(part.column("text")):
                found = text.split() if text else []
                lengths.append(len(found))
                ids += [number(w, len(numbers)) for w in found]
                joined.append(b" ".join(found))
                places.append([0, *itertools.accumulate(len(w) + 1 for w in found)])
            table = np.array([xxh64_intdigest(w) for w in numbers], dtype=np.uint64)
            hashes = table[np.array(ids, dtype=np.int64)] if ids else np.zeros(0, np.uint64)
            mini, document, first, count, lead = minimisers(
                hashes, np.cumsum(lengths), window, size
            )
            runs = zip(document.tolist(), first.tolist(), count.tolist(), strict=True)
            digests = b"".join(
                digest(joined[d][places[d][f] : places[d][f + n + window - 1] - 1])
                for d, f, n in runs
            )
            halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
            order = np.lexsort((halves[:, 1], halves[:, 0], document))
            marks, place = np.column_stack((document, halves))[order], first[order]
            edge = np.ones(min(1, len(order)), bool)
            other = (marks[1:] != marks[:-1]).any(axis=1)
            parted = other | (np.diff(place) > window)
            heads, tails = np.append(edge, parted), np.append(parted, edge)
            held = np.flatnonzero(np.append(edge, other)[heads])
            chosen = order[heads][held]
            rows = pa.array(document[chosen])
            return pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(rows),
                    part.column("text_key").take(rows),
                    pa.array(mini[chosen]),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(held, heads.sum()), pa.int32()),
                        pa.StructArray.from_arrays(
                            [pa.array(place[e], pa.int32()) for e in (heads, tails)],
                            ["first", "last"],
                        ),
                    ),
                    pa.array(count[chosen].astype(np.int16)),
                    pa.array(lead[chosen].astype(np.int16)),
                    pa.array(halves[chosen, 0]),
                    pa.array(halves[chosen, 1]),
                ],
                ["id", "text_key", "mini", "places", "n", "lead", *DIGEST],
            )

        return step

    return map_slices(
        docs.select("id", "text_key", "text"),
        make,
        f"id bigint, text_key bigint, mini bigint, places {PLACES}, n smallint, lead smallint, "
        "high bigint, low bigint",
    )


# --- sorting the windows of a bucket -----------------------------------------------------


def repeated(
    mini: np.ndarray,
    ids: np.ndarray,
    count: np.ndarray,
    lead: np.ndarray,
    packed: list[bytes],
    window: int,
):
    """(row, from word, behind the last word) covered by windows that a smaller id has too.

    The words are counted from the row's first. Words become numbers, one to one. A window is the words left of the minimiser and those from
    it on; both are numbered by sorting, one word more at a time, so that equal numbers mean equal
    words. For each place of the minimiser the windows are sorted by the two numbers and the id:
    the first of equals has the smallest id, and larger ids are marked.
    """
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    split = [p.split() for p in packed]
    flat = np.array([number(w, len(numbers)) + 1 for words in split for w in words], np.int64)
    size = len(numbers) + 1
    lengths = np.array([len(words) for words in split])
    base = np.cumsum(lengths) - lengths
    centre = base + lead
    rows = len(packed)
    most = int(lead.max()) if rows else 0

    def classes(steps: int, offset: int, sign: int, limit: np.ndarray) -> list[np.ndarray]:
        held = np.unique(mini, return_inverse=True)[1]
        out = [held]
        for i in range(steps):
            at = np.clip(centre + offset + sign * i, 0, len(flat) - 1)
            word = np.where(i < limit, flat[at], 0)
            held = np.unique(held * size + word, return_inverse=True)[1]
            out.append(held)
        return out

    left = classes(most, -1, -1, lead)
    right = classes(window, 0, 1, lengths - lead)
    marked = np.zeros((rows, int(count.max()) + 2 if rows else 2), np.int8)
    for width in range(most + 1):
        which = lead - width
        chosen = np.flatnonzero((which >= 0) & (which < count))
        if not len(chosen):
            continue
        key = left[width][chosen] * (rows + 1) + right[window - width][chosen]
        order = np.lexsort((ids[chosen], key))
        sorted_key, sorted_id = key[order], ids[chosen][order]
        heads = np.append(True, sorted_key[1:] != sorted_key[:-1])
        least = sorted_id[heads][np.cumsum(heads) - 1]
        late = chosen[order[sorted_id > least]]
        marked[late, lead[late] - width + 1] = 1
    change = np.diff(marked, axis=1)
    row, begin = np.nonzero(change == 1)
    _, end = np.nonzero(change == -1)
    return row, begin, end - 1 + window


def at_places(row: np.ndarray, begin: np.ndarray, end: np.ndarray, places: pa.ListArray):
    """(row, from word, behind the last word) at all places of the rows."""
    ends = np.cumsum(places.value_lengths().to_numpy())
    starts, flat = np.append(0, ends)[:-1], places.flatten()
    many = (ends - starts)[row]
    which = np.repeat(np.arange(len(row)), many)
    at = np.arange(len(which)) - (np.cumsum(many) - many - starts[row])[which]
    first, last = (flat.field(f).to_numpy().astype(np.int64)[at] for f in ("first", "last"))
    return row[which], first + begin[which], last + end[which]


def sorted_windows(packed: DataFrame, window: int, chunk: int) -> DataFrame:
    """Marks of all buckets; a bucket's super-k-mers come one after the other."""

    def work(batch: pa.Table) -> pa.RecordBatch:
        values = {c: batch.column(c).to_numpy() for c in ("mini", "id", "n", "lead")}
        found = repeated(
            values["mini"],
            values["id"],
            values["n"].astype(np.int64),
            values["lead"].astype(np.int64),
            batch.column("packed").to_pylist(),
            window,
        )
        row, start, stop = at_places(*found, batch.column("places").combine_chunks())
        keys = batch.column("text_key").to_numpy()
        return pa.RecordBatch.from_arrays(
            [pa.array(values["id"][row]), pa.array(keys[row]), pa.array(start), pa.array(stop)],
            ["id", "text_key", "start", "stop"],
        )

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            while rows >= chunk:
                table = pa.Table.from_batches(held)
                mini = table.column("mini").to_numpy()
                # The last bucket may go on in the next batch.
                cut = int(np.searchsorted(mini[:chunk], mini[chunk - 1])) or int(
                    np.searchsorted(mini, mini[chunk - 1], side="right")
                )
                if cut == len(mini):
                    break
                yield work(table.slice(0, cut))
                rest = table.slice(cut)
                held, rows = rest.to_batches(), rest.num_rows
        if rows:
            yield work(pa.Table.from_batches(held))

    return packed.mapInArrow(run, "id bigint, text_key bigint, start bigint, stop bigint")


# --- the whole table ---------------------------------------------------------------------

CUT = (
    f"mini bigint, id bigint, text_key bigint, places {PLACES}, n smallint, lead smallint, "
    "high bigint, low bigint, packed binary"
)
CUT_NAMES = ["mini", "id", "text_key", "places", "n", "lead", *DIGEST, "packed"]
KINDS = (
    *(pa.int64(),) * 3,
    pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])),
    *(pa.int16(),) * 2,
    *(pa.int64(),) * 2,
    pa.binary(),
)


def _cut_out(joined: DataFrame, window: int) -> DataFrame:
    """The runs asked for: as one string of their words each, or as hashes of single windows."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(KINDS)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, KINDS, strict=True)],
            CUT_NAMES,
        )

    def cut(found: list[bytes], key: int, mark: int, runs: list[dict]):
        for r in runs:
            places, n, mini = r["places"], r["n"], r["mini"]
            first = places[0]["first"]
            if r["crowded"]:
                for s in range(n):
                    halves = digest(b" ".join(found[first + s : first + s + window]))
                    moved = [{end: at + s for end, at in p.items()} for p in places]
                    yield mini, key, mark, moved, 1, 0, *struct.unpack("<qq", halves), None
            else:
                packed = b" ".join(found[first : first + n + window - 1])
                yield mini, key, mark, places, n, r["lead"], None, None, packed

    def run(batches):
        for part in slices(batches):
            out: list[tuple] = []
            columns = (part.column(c).to_pylist() for c in ("id", "text_key", "runs"))
            for text, *of in zip(byte_texts(part.column("text")), *columns, strict=True):
                out += cut(text.split(), *of)
                if len(out) > 20_000:
                    yield batch(out)
                    out = []
            yield batch(out)

    return joined.select("id", "text_key", "text", "runs").mapInArrow(run, CUT)


def later_copies(keyed: DataFrame, window: int, folder: str) -> DataFrame:
    """id, text_key, start and stop of the whole texts that a smaller id has word for word.

    All windows of such a text start under the smaller id too, so that it is settled as a whole.
    Texts shorter than a window have none.
    """
    words = F.trim(F.regexp_replace("text", r"[ \t-\r]+", " "))
    blanks = F.length(words) - F.length(F.replace(words, F.lit(" ")))
    texts = keyed.select("id", "text_key", words.alias("words"), (blanks + 1).alias("stop"))
    texts = texts.filter(F.col("stop") >= window).select(
        "id", "text_key", F.unhex(F.sha2("words", 256)).alias("sha"), "stop"
    )
    texts = stored(texts, f"{folder}/texts")
    first = texts.groupBy("sha").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    first = stored(first.filter("least < most").select("sha", "least"), f"{folder}/first")
    late = texts.join(first, "sha").filter("id > least")
    spans = late.select(
        "id", "text_key", F.lit(0).cast("bigint").alias("start"), F.col("stop").cast("bigint")
    )
    return stored(spans.distinct(), f"{folder}/copies")


def _judged(rows: DataFrame, folder: str) -> DataFrame:
    """Rows with the least id that has the same words, by their hash."""
    least = stored(rows.groupBy(*DIGEST).agg(F.min("id").alias("least")), folder)
    return rows.join(least, DIGEST)


def _span(start: Column, stop: Column) -> Column:
    return F.struct(start.alias("start"), stop.alias("stop"))


def _covered(late: DataFrame, window: int) -> DataFrame:
    """id, text_key and the spans of all places of the rows."""
    more = (F.col("n") - 1 + window).cast("bigint")
    spans = F.transform("places", lambda p: _span(p["first"].cast("bigint"), p["last"] + more))
    return late.select("id", "text_key", spans.alias("spans"))


def dedup(
    docs: DataFrame,
    window: int = WINDOW,
    size: int = MINIMISER,
    bucket: int = BUCKET,
    chunk: int = CHUNK,
) -> DataFrame:
    """doc_id, kept_text, n_words, n_removed and removed spans of every row of ``docs``.

    Removed is every word covered by a window of ``window`` words that also starts in a document
    with a smaller doc_id, judged on the whole input. Consecutive windows with the same minimiser
    are one super-k-mer. Whole texts that a smaller id has word for word are settled first and send
    none; a text sends equal super-k-mers once, with their places. Minimisers met under one id only cannot repeat and go no further. The
    super-k-mers of the others are cut out as packed strings, dealt by minimiser, and their
    windows sorted. Buckets of over ``bucket`` super-k-mers are aggregated before: of equal ones,
    by a 128-bit hash of their words, only those with the least id need sorting, all windows of
    the others are known to repeat. What is still crowded sends its windows singly to the same
    partially aggregated minimum. So no bucket fills a task.

    Kept words are joined by one space. A null or empty text has no words. A null doc_id counts as
    larger than any: its words go if another document has them, and remove none. Rows that share
    a doc_id do not remove each other's words. Texts shorter than a window stay whole. An empty
    table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "super-kmers")
    keyed = docs.select("doc_id", order_id().alias("id"), text_key().alias("text_key"), "text")
    keys = ["id", "text_key"]
    copies = later_copies(keyed, window, folder)
    rows = super_kmers(keyed.join(copies, keys, "left_anti"), window, size)
    rows = stored(rows, f"{folder}/all")
    shared = (
        rows.groupBy("mini")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("held"))
        .filter("low < high")
        .select("mini", (F.col("held") > bucket).alias("crowded"))
    )
    shared = stored(shared, f"{folder}/shared")
    found = stored(rows.join(shared, "mini"), f"{folder}/found")
    wanted = [*keys, "places", "n", "lead", "mini", "crowded"]
    runs, marks = found.filter(~F.col("crowded")).select(*wanted), None
    if not found.filter("crowded").isEmpty():
        whole = _judged(found.filter("crowded").drop("crowded"), f"{folder}/least")
        marks = _covered(whole.filter("id > least"), window)
        own = stored(whole.filter("id = least").select(wanted[:-1]), f"{folder}/own")
        still = own.groupBy("mini").agg((F.count("*") > bucket).alias("crowded"))
        still = stored(still, f"{folder}/still")
        runs = runs.unionByName(own.join(still, "mini").select(*wanted))
    # A set, so that repeated rows add nothing.
    asked = runs.groupBy(*keys).agg(F.collect_set(F.struct(*wanted[2:])).alias("runs"))
    cut = stored(_cut_out(keyed.join(asked, keys), window), f"{folder}/cut")
    packed = cut.filter(F.col("packed").isNotNull()).drop(*DIGEST)
    ordinary = sorted_windows(
        packed.repartition("mini").sortWithinPartitions("mini"), window, chunk
    )
    ordinary = ordinary.unionByName(copies).select(
        *keys, F.array(_span(F.col("start"), F.col("stop"))).alias("spans")
    )
    marks = ordinary if marks is None else marks.unionByName(ordinary)
    single = cut.filter(F.col("packed").isNull()).drop("packed")
    if not single.isEmpty():
        late = _judged(single, f"{folder}/single").filter("id > least")
        marks = marks.unionByName(_covered(late, window))
    spans = marks.groupBy(*keys).agg(F.flatten(F.collect_set("spans")).alias("spans"))
    return _without(keyed.join(spans, keys, "left"), docs.schema["doc_id"].dataType.simpleString())


def _without(joined: DataFrame, kind: str) -> DataFrame:
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def one(text: bytes | None, spans: list[dict] | None):
        found = text.split() if text else []
        if not spans:
            return b" ".join(found), len(found), 0, []
        merged: list[list[int]] = []
        for s in sorted((s["start"], s["stop"]) for s in spans):
            if merged and s[0] <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], s[1])
            else:
                merged.append([*s])
        kept, at = [], 0
        for start, stop in merged:
            kept += found[at:start]
            at = stop
        kept += found[at:]
        gone = [{"start": a, "stop": b} for a, b in merged]
        return b" ".join(kept), len(found), len(found) - len(kept), gone

    def run(batches):
        for part in slices(batches):
            rows = [
                one(text, spans)
                for text, spans in zip(
                    byte_texts(part.column("text")), part.column("spans").to_pylist(), strict=True
                )
            ]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(span))
            columns = zip(zip(*rows, strict=True), kinds, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(c, t) for c, t in columns]],
                ["doc_id", "kept_text", "n_words", "n_removed", "removed"],
            )

    return joined.select("doc_id", "id", "text_key", "text", "spans").mapInArrow(
        run,
        f"doc_id {kind}, kept_text string, n_words bigint, n_removed bigint, "
        "removed array<struct<start: bigint, stop: bigint>>",
    )
