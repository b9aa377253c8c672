"""Cross-tokenizer alignment: tokens of two tokenizers grouped and linked by their byte ranges."""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketbars.llm.common import kind_of, map_slices, stored
from marketbars.session import work_dir

# Stretches that a worker remembers, beside those of the documents at hand.
MEMORY = 600_000
# Stretches whose tokens are sorted at once; longer documents are sorted in pieces.
LAP = 200_000
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
OTHER = WHITE.replace(r"\t-\r ", r"\t\x0b-\r")
# From a blank or line feed behind other signs up to the next such place.
STRETCH = re.compile(f"[ \\n][{WHITE}]*[^{WHITE}]*(?:[{OTHER}][{WHITE}]*[^{WHITE}]*)*").findall
PROBE = " The quick, brown\tfox  jumps\n over the\n\n12 lazy dogs. Élan\x1c ÀÉ, naïve  \n x "


# --- the two tokenizers ------------------------------------------------------------------


class ByteLevel:
    """A byte-level tokenizer file. ``octets`` has the bytes of every id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.octets = _byte_level_octets(self.tokenizer.get_vocab())
        with open(path) as file:
            rules = json.load(file)
        cut = rules.get("pre_tokenizer") or {}
        plain = rules.get("normalizer") is None and rules["model"]["type"] == "BPE"
        self.cuts = plain and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    # The tokenizer cuts between a sign and the white space behind it: stretches are whole texts.
    stretches = whole


def _byte_level_octets(vocabulary: dict[str, int]) -> list[bytes]:
    """Printable bytes stand for themselves, the others for the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    value = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    octets = [b""] * (max(vocabulary.values()) + 1)
    for token, number in vocabulary.items():
        known = all(c in value for c in token)
        octets[number] = bytes(value[c] for c in token) if known else token.encode()
    return octets


class Pieces:
    """A sentence-piece file, which puts a blank before each text by itself."""

    BLANK = "▁"

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.octets = [
            bytes([int(name[3:5], 16)])
            if self.model.is_byte(i)
            else name.replace(self.BLANK, " ").encode()
            for i, name in enumerate(names)
        ]
        # No piece goes on over a blank, or holds a line feed beside other signs.
        self.cuts = not any(self.BLANK in n.lstrip(self.BLANK) or "\n" in n for n in names)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([text[1:] for text in texts], num_threads=1)

    def stretches(self, texts: list[str]) -> list[list[int]]:
        # Behind a line feed, so that blanks at the start and end count like any others.
        found = self.model.encode(["\n" + text for text in texts], num_threads=1)
        return [ids[2:] for ids in found]


class Pair:
    """Ids of both tokenizers for texts with a blank before them.

    If both are known to cut texts into the same stretches, and do so with a probe, stretches are
    asked for once and remembered; otherwise each text is one stretch. ``tests/llm`` compares
    both ways.
    """

    def __init__(self, a: str, b: str, memory: int = MEMORY):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.memory = memory
        self.cuts = self.a.cuts and self.b.cuts and self._probed()
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def _probed(self) -> bool:
        return all(
            side.whole([PROBE])[0] == [i for ids in side.stretches(STRETCH(PROBE)) for i in ids]
            for side in (self.a, self.b)
        )

    def _packed(self, texts: list[str], a: list[list[int]], b: list[list[int]]):
        """Packed ids of both sides for every text; None where bytes differ from the text's."""
        octets = [text.encode() for text in texts]
        sides = []
        for known, ids in ((self.a.octets, a), (self.b.octets, b)):
            flat = [*itertools.chain.from_iterable(ids)]
            ends = [4 * n for n in itertools.accumulate(map(len, ids), initial=0)]
            spelt = [known[i] for i in flat]
            lengths = np.cumsum([0, *map(len, spelt)])[np.array(ends, np.int64) // 4]
            alike = b"".join(spelt) == b"".join(octets)
            if not alike or np.diff(lengths).tolist() != [*map(len, octets)]:
                good = [b"".join(known[i] for i in x) == o for x, o in zip(ids, octets, strict=True)]
            else:
                good = itertools.repeat(True)
            buffer = np.array(flat, "<i4").tobytes()
            sides.append((good, [buffer[x:y] for x, y in itertools.pairwise(ends)]))
        (good_a, a), (good_b, b) = sides
        pairs = zip(a, b, strict=True)
        return [p if x and y else None for p, x, y in zip(pairs, good_a, good_b, strict=False)]

    def encode(self, texts: list[str | None]) -> list[list[tuple[bytes, bytes]]]:
        """Packed ids of both for every stretch of every text; none for a text whose bytes either
        does not give back."""
        spaced = [" " + text if text else None for text in texts]
        if not self.cuts:
            whole = [text for text in spaced if text]
            ids = iter(self._packed(whole, self.a.whole(whole), self.b.whole(whole)))
            found = [[next(ids)] if text else [] for text in spaced]
        else:
            cut = [STRETCH(text) if text else [] for text in spaced]
            new = list(set(itertools.chain.from_iterable(cut)).difference(self.known))
            made = self._packed(new, self.a.stretches(new), self.b.stretches(new))
            self.known.update(zip(new, made, strict=True))
            found = [[*map(self.known.__getitem__, stretches)] for stretches in cut]
            if len(self.known) > self.memory:
                # Those met first go first; what is frequent comes back at once.
                for text in [*itertools.islice(self.known, len(self.known) - self.memory * 2 // 3)]:
                    del self.known[text]
        return [[] if None in ids else ids for ids in found]


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(a: str, b: str) -> Pair:
    """This Python worker's tokenizers, kept from task to task."""
    if (a, b) not in _PAIRS:
        _PAIRS[a, b] = Pair(a, b)
    return _PAIRS[a, b]


# --- groups and links --------------------------------------------------------------------


def coalesced(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Number of the group of every token: a group ends where a start reaches all ends so far."""
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    first = np.ones(len(order), bool)
    first[1:] = start[order[1:]] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(first) - 1
    return group


def overlapping(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of an A and a B token that share a byte; both sides in order."""
    low = np.searchsorted(b_end, a_start, "right")
    times = np.searchsorted(b_start, a_end, "left") - low
    skipped = np.cumsum(times) - times
    left = np.repeat(np.arange(len(times)), times)
    return left, np.arange(len(left)) + np.repeat(low - skipped, times)


class Lap:
    """Pieces of documents laid end to end, sorted and linked at once."""

    def __init__(self, pair: Pair):
        self.octets = [np.array([len(o) for o in s.octets], np.int64) for s in (pair.a, pair.b)]
        self.n_b = len(pair.b.octets)
        ids = max(len(pair.a.octets), self.n_b)
        self.written = [b"%d%s" % (i, end) for i in range(ids) for end in (b",", b"|", b";", b"")]

    def __call__(self, pieces: list[tuple[bytes, bytes, bool]]):
        """Per piece: n_a, n_b, n_groups, n_links, groups as bytes; then the linked id pairs of all
        pieces and the piece of each. Each piece has both its ids and whether it is a text's last.
        """
        a, b = (np.frombuffer(b"".join(p[i] for p in pieces), "<i4") for i in (0, 1))
        n_a, n_b = (np.array([len(p[i]) // 4 for p in pieces]) for i in (0, 1))
        ends = [np.cumsum(size[ids]) for size, ids in zip(self.octets, (a, b), strict=True)]
        starts = [end - size[ids] for end, size, ids in zip(ends, self.octets, (a, b), strict=True)]
        side = np.repeat(np.array([0, 1], np.int8), [len(a), len(b)])
        group = coalesced(np.concatenate(starts), np.concatenate(ends), side)
        left, right = overlapping(starts[0], ends[0], starts[1], ends[1])
        linked = a[left].astype(np.int64) * self.n_b + b[right]
        number = np.arange(len(pieces))
        of_a = np.repeat(number, n_a)
        of_link = of_a[left]
        heads = np.flatnonzero(np.diff(group[: len(a)], prepend=-1))
        n_groups = np.bincount(of_a[heads], minlength=len(pieces))
        n_links = np.bincount(of_link, minlength=len(pieces))
        # A's ids of a group, then B's; each with what follows it.
        order = np.lexsort((side, group))
        ids, group, side = np.concatenate((a, b))[order], group[order], side[order]
        turn = np.zeros(len(ids), np.int64)
        turn[:-1] = np.where(group[1:] != group[:-1], 2, (side[1:] != side[:-1]) * 1)
        stops = np.cumsum(n_a + n_b)
        last = np.array([p[2] for p in pieces])
        turn[stops - 1] = np.where(last, 3, 2)
        words = (ids * 4 + turn).tolist()
        write = self.written.__getitem__
        groups = [
            b"".join(map(write, words[x:y])) for x, y in itertools.pairwise([0, *stops.tolist()])
        ]
        return [n_a, n_b, n_groups, n_links], groups, linked, of_link


def _laps(texts: list[list[tuple[bytes, bytes]]], most: int):
    """Lists of (document, A's ids, B's ids, last piece?) with up to about ``most`` stretches."""
    held, size = [], 0
    for row, found in enumerate(texts):
        for at in range(0, len(found), most):
            part = found[at : at + most]
            held.append((row, *map(b"".join, zip(*part, strict=True)), at + most >= len(found)))
            size += len(part)
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _squeezed(numbers: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(numbers, "<i8").tobytes(), 1)


def _spread(squeezed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(squeezed), "<i8")


def blocks(docs: DataFrame, a: str, b: str, lap: int = LAP) -> DataFrame:
    """A row per document, and one per block of documents with the id pairs linked in it.

    ``row`` numbers the documents of a block; in the block's own row it is null, ``pairs`` holds
    the distinct linked pairs (A's id times B's vocabulary plus B's id) and ``times`` their
    number. ``links`` says which of them each document has how often: three compressed arrays.
    """
    kind = kind_of(docs, "doc_id")
    schema = (
        f"block string, row int, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, "
        "n_links bigint, groups string, pairs array<bigint>, times array<bigint>, "
        "links array<binary>"
    )

    def make():
        pair = pair_of(a, b)
        work = Lap(pair)

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = pair.encode(part.column("text").to_pylist())
            counts = np.zeros((4, len(texts)), np.int64)
            written: list[list[bytes]] = [[] for _ in texts]
            keys, owners, numbers = [], [], []
            for pieces in _laps(texts, lap):
                rows = np.array([p[0] for p in pieces])
                found, groups, linked, of = work([p[1:] for p in pieces])
                for total, more in zip(counts, found, strict=True):
                    np.add.at(total, rows, more)
                for row, group in zip(rows.tolist(), groups, strict=True):
                    written[row].append(group)
                # Equal pairs of a document side by side.
                order = np.lexsort((linked, of))
                linked, of = linked[order], rows[of[order]]
                heads = np.flatnonzero(
                    (np.diff(linked, prepend=-1) != 0) | (np.diff(of, prepend=-1) != 0)
                )
                keys.append(linked[heads])
                owners.append(of[heads])
                numbers.append(np.diff(np.append(heads, len(linked))))
            key, owner, number = (
                np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)
                for x in (keys, owners, numbers)
            )
            pairs, at = np.unique(key, return_inverse=True)
            times = np.bincount(at, number, len(pairs)).astype(np.int64)
            links = [_squeezed(np.diff(x, prepend=0)) for x in (owner, at)] + [_squeezed(number)]
            none = [None] * len(texts)
            columns = {
                "block": [uuid.uuid4().hex] * (len(texts) + 1),
                "row": [*range(len(texts)), None],
                "doc_id": None,
                **{name: [*c.tolist(), None] for name, c in zip(COUNTS, counts, strict=True)},
                "groups": [*map(b"".join, written), None],
                "pairs": [*none, pairs],
                "times": [*none, times],
                "links": [*none, links],
            }
            ids = pa.concat_arrays(
                [part.column("doc_id"), pa.nulls(1, part.column("doc_id").type)]
            )
            types = {"row": pa.int32(), "pairs": pa.list_(pa.int64()), "block": pa.string()}
            types |= {"times": types["pairs"], "links": pa.list_(pa.binary())}
            types |= {"groups": pa.binary()} | dict.fromkeys(COUNTS, pa.int64())
            arrays = [
                ids if name == "doc_id" else pa.array(values, types[name])
                for name, values in columns.items()
            ]
            at_groups = [*columns].index("groups")
            arrays[at_groups] = arrays[at_groups].cast(pa.string())
            return pa.RecordBatch.from_arrays(arrays, [*columns])

        return step

    return map_slices(docs.select("doc_id", "text"), make, schema)


def _summed(part: pa.Table, counted: pa.Table) -> pa.Table:
    """The documents of a block, with what their links count in the whole corpus."""
    rows = part.column("row").to_pylist()
    n = len(rows) - 1
    owner, at, number = map(_spread, part.column("links").to_pylist()[rows.index(None)])
    owner, at = np.cumsum(owner), np.cumsum(at)
    order = np.argsort(counted.column("at").to_numpy())
    total = counted.column("total").to_numpy()[order]
    best = counted.column("best").to_numpy(zero_copy_only=False)[order]
    n_best, count_sum = np.zeros((2, n), np.int64)
    np.add.at(n_best, owner, number * best[at])
    np.add.at(count_sum, owner, number * total[at])
    docs = part.filter(pc.is_valid(part.column("row")))
    mine = docs.column("row").to_numpy()
    out = docs.select(["doc_id", *COUNTS])
    out = out.append_column("n_best", pa.array(n_best[mine]))
    out = out.append_column("count_sum", pa.array(count_sum[mine]))
    return out.append_column("groups", docs.column("groups"))


def align(
    docs: DataFrame,
    a: str,
    b: str,
    written: Callable[[Column], Column] | None = None,
    lap: int = LAP,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups of every row of ``docs``.

    ``a`` is a byte-level tokenizer file, ``b`` a sentence-piece file; both encode a text with a
    blank before it, special tokens' names as plain text. All tokens of both are sorted by their
    first byte; a group ends where a token starts at or behind all ends so far, so where tokens of
    both end. ``groups`` lists ids as ``a1,a2|b1;a3|b2``; ``written`` may turn it into something
    shorter before it is stored. An A and a B token are linked if they share a byte. ``count_sum``
    adds up, over a document's links, how often the linked id pair occurs in the whole corpus;
    ``n_best`` counts the links whose pair occurs most often of all pairs with this B id.

    Pairs are counted per block of documents, then summed in Spark; a block asks for the totals of
    its own distinct pairs, so that no task holds more than a block. Sent to all tasks is one
    number per B id, at most as many as B's vocabulary.

    Null and empty texts have no tokens: zeros and an empty ``groups``; so have texts that either
    tokenizer does not give back byte for byte. Long texts are sorted in pieces that no token
    crosses. Repeated rows and ids are kept and counted like others. An empty table gives no rows;
    other columns are not read.
    """
    folder = work_dir(docs.sparkSession, "alignment")
    found = blocks(docs, a, b, lap)
    if written is not None:
        found = found.withColumn("groups", written(F.col("groups")))
    found = stored(found, f"{folder}/blocks")
    n_b = F.lit(sentencepiece.SentencePieceProcessor(model_file=b).get_piece_size())
    pairs = found.filter("row IS NULL").select(
        F.col("block").alias("of_block"),
        F.posexplode(F.arrays_zip("pairs", "times")).alias("at", "of"),
    ).select("of_block", "at", "of.pairs", "of.times")
    totals = stored(
        pairs.groupBy("pairs").agg(F.sum("times").alias("total")), f"{folder}/totals"
    ).withColumn("b_id", F.col("pairs") % n_b)
    highest = totals.groupBy("b_id").agg(F.max("total").alias("highest"))
    counts = totals.join(F.broadcast(highest), "b_id").select(
        "pairs", "total", (F.col("total") == F.col("highest")).alias("best")
    )
    counted = pairs.join(counts, "pairs").select("of_block", "at", "total", "best")
    kind = kind_of(docs, "doc_id")
    shape = ", ".join(f"{name} bigint" for name in (*COUNTS, "n_best", "count_sum"))
    return (
        found.groupBy("block")
        .cogroup(counted.groupBy("of_block"))
        .applyInArrow(
            _summed,
            f"doc_id {kind}, {shape}, groups {kind_of(found, 'groups')}",
        )
    )
