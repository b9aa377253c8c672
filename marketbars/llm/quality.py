"""Quality rules: zstandard compression bands over whole documents and fixed chunks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from marketbars.llm.common import byte_texts, kind_of, map_slices, words

LEVEL = 3
CHUNK = 4096
# A last chunk shorter than this is judged only as part of the whole.
LEAST_CHUNK = 512
# Share of chunks that may lie outside the band.
CHUNK_SHARE = 1 / 3
# (bytes from, lowest ratio, highest ratio) of whole documents. Short texts hardly compress,
# long ones repeat more words: each length has its own limits. Base64 comes to 1.33 at most.
BANDS = (
    (0, 0.0, 3.0),
    (256, 1.2, 3.0),
    (512, 1.3, 3.0),
    (1024, 1.4, 3.0),
    (2048, 1.45, 3.2),
    (16384, 1.5, 3.6),
    (131072, 1.5, 4.5),
)

LEAST_WORDS = 50
MOST_REPEATED = 0.5
SYMBOLS = b"#*$%&|<>"
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
CONTINUATION = bytes(range(0x80, 0xC0))


def band(size: int, bands=BANDS) -> tuple[float, float]:
    """The limits of a text of ``size`` bytes."""
    low, high = bands[0][1:]
    for start, new_low, new_high in bands:
        if size >= start:
            low, high = new_low, new_high
    return low, high


class Bands:
    """Compression ratios of a text and its chunks, held against the bands."""

    def __init__(self, bands=BANDS, chunk: int = CHUNK, level: int = LEVEL):
        self.bands, self.chunk = bands, chunk
        self.compress = zstandard.ZstdCompressor(level=level, write_content_size=False).compress

    def ratio(self, text: bytes) -> float:
        return len(text) / len(self.compress(text)) if text else 0.0

    def judge(self, text: bytes) -> tuple[float, int, int, bool]:
        """Ratio of the whole, chunks judged, chunks outside their band, verdict."""
        whole = self.ratio(text)
        low, high = band(len(text), self.bands)
        parts = range(0, len(text), self.chunk) if len(text) > self.chunk else ()
        judged = outside = 0
        for start in parts:
            part = text[start : start + self.chunk]
            if len(part) < LEAST_CHUNK:
                continue
            judged += 1
            least, most = band(len(part), self.bands)
            outside += not least <= self.ratio(part) <= most
        good = low <= whole <= high and outside <= CHUNK_SHARE * judged
        return whole, judged, outside, good


def repeated_words(found: list[bytes]) -> int:
    """Words in three-word windows that occur at least twice in the text."""
    if len(found) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in found], dtype=np.int64)
    pairs = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) >= 2_000_000:  # three factors would pass 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= twice
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def quality(docs: DataFrame, bands=BANDS, chunk: int = CHUNK) -> DataFrame:
    """One row per document: counts, compression ratios, and whether it is kept.

    ``base_failed``: fewer than 50 words, or over half the words in repeated three-word windows.
    ``kept``: not base_failed, the whole text's ratio inside the band of its length, and at most
    a third of its chunks outside theirs. A null or empty text has no words, ratio 0, and is not
    kept. Repeated rows are judged each for itself; other columns are not read.
    """
    kind = kind_of(docs, "doc_id")
    schema = (
        f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, ratio double, n_chunks bigint, "
        "n_chunks_outside bigint"
    )

    def make():
        judge = Bands(bands, chunk).judge

        def row(text: bytes | None):
            text = text or b""
            found = words(text)
            repeated = repeated_words(found)
            failed = len(found) < LEAST_WORDS or repeated > MOST_REPEATED * len(found)
            ratio, judged, outside, good = judge(text)
            return (
                len(found),
                len(text.translate(None, BLANKS + CONTINUATION)),
                len(text) - len(text.translate(None, SYMBOLS)),
                repeated_lines(text),
                repeated,
                failed,
                good and not failed,
                ratio,
                judged,
                outside,
            )

        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = [row(text) for text in byte_texts(part.column("text"))]
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = [n.split()[0] for n in schema.split(", ")]
            return pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names)

        return step

    return map_slices(docs.select("doc_id", "text"), make, schema)
