"""Small tables that hold what must not break an operator, and plain references."""

from __future__ import annotations

import collections

import numpy as np
import xxhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
PROSE = (
    "the quick brown fox jumps over the lazy dog while seven small birds sing songs about rain "
    "and snow in the old garden behind the red house near a quiet river where nobody ever comes "
    "to fish or swim because the water is cold and deep and full of stones that cut your feet "
    "when you walk"
)


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text))


ODD = [
    row(1, PROSE),
    row(2, PROSE),
    row(2, PROSE),
    row(2, PROSE + " but this text with the same number ends in another way"),
    row(3, None),
    row(4, ""),
    row(5, " \t\n "),
    row(6, "one"),
    row(7, "one two"),
    row(8, LONG),
    row(9, PROSE + "\nmore\n\n" + PROSE, None, None),
    row(None, PROSE),
    row(None, None, None, None),
    row(10, "<|endoftext|> #*$%&|<> é \x1c ß 漢字 \x0b end", "de", "b"),
    row(11, "12345 ... !!!", "de", "b"),
]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def clashing(df):
    """The frame with columns named like what operators use inside."""
    extra = (
        "id text_key words at seed kept fingerprint print component_id root node slot start block "
        "name row part ids mini first n lead spans gone asked runs value kind canon core place "
        "n_entities kept_id kept_text of_id of_text of_lane found_id found_text text_hash "
        "row_number copies lane bucket key"
    ).split()
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit("x") for name in extra})


def split(text):
    return (text or "").encode().split()


def brute_fingerprint(text):
    found = (text or "").encode().lower().split()
    shingles = [b" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    mark = 0
    for bit in range(64):
        if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes):
            mark |= 1 << bit
    return mark


def brute_groups(prints, most):
    """Value -> least value it is linked to, however far."""
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= most:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def brute_windows(rows, size):
    """Per row: kept words and number removed, ids compared as the contract says."""
    last = (1 << 63) - 1
    first = {}
    for doc_id, text, *_ in rows:
        words = split(text)
        key = last if doc_id is None else doc_id
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            first[window] = min(first.get(window, last), key)
    out = collections.Counter()
    for doc_id, text, *_ in rows:
        words = split(text)
        key = last if doc_id is None else doc_id
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] < key:
                gone[i : i + size] = True
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        out[doc_id, len(words), int(gone.sum()), kept] += 1
    return out
