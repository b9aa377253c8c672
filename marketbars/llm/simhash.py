"""SimHash near-duplicates, found by pigeonring filtering."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from marketbars.llm.common import byte_texts, free_names, kind_of, map_slices, stored, text_key
from marketbars.llm.components import components
from marketbars.session import work_dir

SEED = 42
SHINGLE = 3
MOST_BITS = 2
BITS = 64
# Segments of the ring. With two bits allowed, seven consecutive equal ones start a chain.
SEGMENTS = 16
# Fingerprints a bucket may have to be compared pair by pair.
PAIRED = 64
# Hashes counted at once.
BLOCK = 65536


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is 1 if it is 1 in over half the shingles' hashes; no words: 0."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(found)) - 1
    spans = zip(starts[: len(found) - width].tolist(), ends[width:].tolist(), strict=True)
    hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in spans], dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), BLOCK):
        octets = hashes[start : start + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, text_key, fingerprint (as a signed number) of every row."""
    kind = kind_of(docs, "doc_id")

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            marks = [fingerprint(t, shingle, seed) for t in byte_texts(part.column("text"))]
            signed = np.array(marks, dtype=np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(signed)],
                ["doc_id", "text_key", "print"],
            )

        return step

    rows = docs.select("doc_id", "text", text_key().alias("text_key"))
    return map_slices(rows, make, f"doc_id {kind}, text_key bigint, print bigint")


# --- pigeonring --------------------------------------------------------------------------


def budgets(segments: int, most: int) -> list[int]:
    """Differences a chain of 1, 2, ... segments may have: the whole budget in proportion."""
    return [length * most // segments for length in range(1, segments + 1)]


def turned(value: Column, segment: int, segments: int) -> Column:
    """The ring of 64 bits, turned so that ``segment`` comes first (lowest)."""
    shift = segment * BITS // segments
    if shift == 0:
        return value
    return F.shiftrightunsigned(value, shift).bitwiseOR(F.shiftleft(value, BITS - shift))


def low_bits(n: int) -> Column:
    return F.lit((1 << n) - 1 if n < BITS else -1)


def chain_ok(left: Column, right: Column, start: Column, segments: int, most: int) -> Column:
    """Every prefix of the chain that begins at ``start`` stays within its budget."""
    allowed = budgets(segments, most)
    width = BITS // segments
    # Sums only grow along a chain, so that the longest prefix of each budget decides.
    longest = {budget: length for length, budget in enumerate(allowed, 1)}
    test = F.lit(False)
    for segment in range(segments):
        diff = turned(left.bitwiseXOR(right), segment, segments)
        good = F.lit(True)
        for budget, length in longest.items():
            good = good & (F.bit_count(diff.bitwiseAND(low_bits(width * length))) <= budget)
        test = F.when(start == segment, good).otherwise(test)
    return test


def links(prints: DataFrame, most: int = MOST_BITS, segments: int = SEGMENTS, paired: int = PAIRED):
    """Edges (u, v) that join exactly what distances of at most ``most`` bits join.

    ``prints`` has distinct fingerprints in column ``print``. Some chain of segments of two such
    fingerprints keeps every prefix within budget, and begins with segments that are equal: their
    bits and place are the bucket. Buckets of up to ``paired`` fingerprints are compared pair by
    pair: chain budgets first, full distance last. The members of a larger bucket go another way
    that is as exact and has no large group (``star_links``).
    """
    allowed = budgets(segments, most)
    equal = sum(budget == 0 for budget in allowed) * BITS // segments
    if BITS % segments or not equal:
        raise ValueError("segments must divide 64 and be more than the bits allowed")
    chains = [turned(F.col("print"), s, segments).bitwiseAND(low_bits(equal)) for s in range(segments)]
    keyed = prints.select(
        "print", F.posexplode(F.array(*chains)).alias("segment", "chain")
    )
    sizes = keyed.groupBy("segment", "chain").agg(F.count("*").alias("held")).filter("held > 1")
    shared = keyed.join(sizes, ["segment", "chain"])
    buckets = shared.filter(F.col("held") <= paired)
    left = buckets.select("segment", "chain", F.col("print").alias("u"))
    right = buckets.select("segment", "chain", F.col("print").alias("v"))
    pairs = left.join(right, ["segment", "chain"]).filter("v < u")
    near = pairs.filter(
        chain_ok(F.col("u"), F.col("v"), F.col("segment"), segments, most)
        & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= most)
    ).select("u", "v")
    crowded = shared.filter(F.col("held") > paired).select("print").distinct()
    return near.unionByName(star_links(crowded, most))


def star_links(prints: DataFrame, most: int) -> DataFrame:
    """Links of fingerprints that crowd one bucket, in groups of at most 65.

    Two fingerprints are at most two bits apart just when some value is at most one bit from
    either. Each is sent to itself and its 64 neighbours; those that meet at a value are linked
    through the least of them. One bit apart: one of the two is the value. Equal ones are one.
    """
    if most not in (1, 2):
        raise ValueError("crowded buckets are resolved for one or two bits")
    flips = F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(BITS)])
    near = F.concat(
        F.array(F.col("print")), F.transform(flips, lambda f: F.col("print").bitwiseXOR(f))
    )
    met = (
        prints.select("print", F.explode(near).alias("value"))
        .groupBy("value")
        .agg(F.collect_set("print").alias("met"))
        .filter(F.size("met") > 1)
    )
    found = met.select(F.explode("met").alias("u"), F.array_min("met").alias("v")).filter("u != v")
    found = found.distinct()
    if most == 1:
        found = found.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 1)
    return found


def groups(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST_BITS, seed: int = SEED):
    """doc_id, text_key, print and component_id of every row of ``docs``.

    Rows whose fingerprints differ in at most ``most`` bits are linked; component_id is the
    smallest doc_id reachable. A null or empty text, or one of white space, has fingerprint 0 and
    is linked like any other. Equal texts, repeated rows and rows that share a doc_id are one
    group. A null doc_id takes part and gets its group's smallest id, null if there is none. An
    empty table gives no rows; other columns are not read.
    """
    folder = work_dir(docs.sparkSession, "simhash")
    rows = stored(fingerprints(docs, shingle, seed), f"{folder}/rows")
    prints = rows.groupBy("print").agg(F.min("doc_id").alias("first"))
    found = components(links(prints.select("print"), most))
    rooted = prints.join(found, prints["print"] == found["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(least, "root").select("print", "component_id", "root")
    return rows.join(stored(classes, f"{folder}/classes"), "print")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row; see ``groups``."""
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return groups(docs).select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST_BITS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the smallest doc_id stays.

    Rows that share that doc_id: the one whose text has the least hash, once if rows repeat. A
    null id stays only where its group has no other. Columns are as in ``docs``.
    """
    id_name, text_name = free_names(docs, "kept_id", "kept_text")
    number = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))
    kept = (
        groups(docs, shingle, most)
        .groupBy("root")
        .agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "text_key")).alias("kept"))
        .select(
            F.coalesce(F.col("kept.doc_id").cast("bigint"), F.lit(-(1 << 63))).alias(id_name),
            F.col("kept.text_key").alias(text_name),
        )
    )
    marked = docs.withColumns({id_name: number, text_name: text_key()})
    keys = [id_name, text_name]
    return marked.join(kept, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
