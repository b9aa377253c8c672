"""Language of documents: scripts narrow the candidates, Viterbi labels spans of words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import kind_of, slices

UNKNOWN = "und"
# About so many labelled documents, chosen by hash, train the model.
TRAIN_DOCS = 20_000
# Hashed letter groups per language: the model has languages x BUCKETS numbers, whatever the data.
BUCKETS = 1 << 16
# Words whose letter groups are counted at once.
COUNTED = 50_000
# Log-odds one word may carry, and the price of a change of language between two words.
WORD_LIMIT = 4.0
SWITCH = 16.0
# A language is a candidate for a script that has at least this share of its letters.
SCRIPT_SHARE = 0.005

# First code points of Unicode ranges, by script.
RANGES = (
    (0x0000, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0780, "Other"),
    (0x0900, "Devanagari"),
    (0x0980, "Bengali"),
    (0x0A00, "Indic"),
    (0x0E00, "Thai"),
    (0x0E80, "Other"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Other"),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, "Other"),
    (0x3040, "Kana"),
    (0x3100, "Other"),
    (0x3400, "Han"),
    (0xA000, "Other"),
    (0xAC00, "Hangul"),
    (0xD7B0, "Other"),
    (0xF900, "Han"),
    (0xFB00, "Other"),
    (0x20000, "Han"),
    (0x30000, "Other"),
)
SCRIPTS = sorted({name for _, name in RANGES})


def held_out(doc_id: Column) -> Column:
    """Documents never learned from; false for a null id, which is not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Letters:
    """Letter groups of words, worked out for many words at once."""

    def __init__(self):
        self.letter = np.zeros(0x110000, bool)
        for code in range(0x33480):
            if chr(code).isalpha():
                self.letter[code] = True
        starts = np.array([start for start, _ in RANGES])
        of_range = np.array([SCRIPTS.index(name) for _, name in RANGES])
        codes = np.arange(0x110000)
        self.script = of_range[np.searchsorted(starts, codes, side="right") - 1].astype(np.int8)

    def groups(self, words: list[str]):
        """Of every letter: its word, the hashes of its pair and triple; letters per word."""
        text = "\n" + "\n".join(words) + "\n"
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        owner = np.cumsum(codes == 10) - 1
        known = self.letter[codes]
        codes = np.where(known, codes, 0)
        at = np.flatnonzero(known)
        one, two, three = codes[at - 1], codes[at], codes[at + 1]
        pair = ((two * 0x9E3779B1 + three * 0x85EBCA77) >> 7) % BUCKETS
        triple = ((one * 0xC2B2AE3D + two * 0x27D4EB2F + three * 0x165667B1) >> 7) % BUCKETS
        return owner[at], pair, triple, self.script[two]


@dataclass(frozen=True)
class Model:
    """Log-probabilities of letter groups per language, and the candidates of each script."""

    languages: tuple[str, ...]
    logs: np.ndarray  # buckets x languages
    candidate: np.ndarray  # scripts x languages


def train(docs: DataFrame, most: int = TRAIN_DOCS) -> Model:
    """Fit on about ``most`` documents with a language and an id that is not held out.

    Letter groups are counted where the documents are, summed by Spark per language and bucket.
    At most languages x (buckets + scripts) sums reach the driver.
    """
    usable = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull()
        & F.col("text").isNotNull()
        & F.col("doc_id").isNotNull()
        & ~held_out(F.col("doc_id"))
    )
    rows = usable.count()
    if rows > most:
        dealt = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
        usable = usable.filter(dealt < int(most / rows * (1 << 30)))

    def run(batches):
        letters, sums = Letters(), {}
        for part in slices(batches):
            texts, langs = part.column("text").to_pylist(), part.column("lang").to_pylist()
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(texts, langs, strict=True):
                by_lang.setdefault(lang, []).extend(text.lower().split())
            for lang, found in by_lang.items():
                counts = sums.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                for start in range(0, len(found), COUNTED):
                    _, pair, triple, script = letters.groups(found[start : start + COUNTED])
                    counts[:BUCKETS] += np.bincount(pair, minlength=BUCKETS)
                    counts[:BUCKETS] += np.bincount(triple, minlength=BUCKETS)
                    counts[BUCKETS:] += np.bincount(script, minlength=len(SCRIPTS))
        for lang, counted in sums.items():
            at = np.flatnonzero(counted)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at), pa.array(counted[at])],
                ["lang", "bucket", "n"],
            )

    counted = (
        usable.mapInArrow(run, "lang string, bucket bigint, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = tuple(sorted(set(counted["lang"])))
    table = np.zeros((BUCKETS + len(SCRIPTS), len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    table[counted["bucket"], counted["lang"].map(place)] = counted["n"]
    groups, scripts = table[:BUCKETS], table[BUCKETS:]
    logs = np.log((groups + 0.5) / (groups.sum(axis=0) + 0.5 * BUCKETS))
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    return Model(languages, logs.astype(np.float32), share >= SCRIPT_SHARE)


def word_scores(model: Model, letters: Letters, words: list[str]):
    """Log-odds of each word per language, its letters, and whether its script is known.

    Languages that do not write the word's script get the lowest value, the candidates their
    distance from the candidates' mean. Words without letters, and those in a script that no
    language uses, favour none.
    """
    n_letters = np.zeros(len(words), np.int64)
    scores = np.zeros((len(words), len(model.languages)), np.float32)
    known = np.zeros(len(words), bool)
    for start in range(0, len(words), COUNTED):
        call = words[start : start + COUNTED]
        owner, pair, triple, script = letters.groups(call)
        n_letters[start : start + len(call)] = np.bincount(owner, minlength=len(call))
        if not len(owner) or not model.languages:
            continue
        heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sums = np.add.reduceat(model.logs[pair] + model.logs[triple], heads, axis=0)
        may = model.candidate[script[heads]]
        some = may.any(axis=1, keepdims=True)
        mean = (sums * may).sum(axis=1, keepdims=True) / np.maximum(may.sum(axis=1), 1)[:, None]
        odds = np.clip(sums - mean, -WORD_LIMIT, WORD_LIMIT)
        at = start + owner[heads]
        scores[at] = np.where(some, np.where(may, odds, -WORD_LIMIT), 0)
        known[at] = some[:, 0]
    return scores, n_letters, known


def one_language(scores: np.ndarray, switch: float) -> int | None:
    """The best language if no change of language can pay, else None.

    If no run of words gains more than half a switch over the document's best language, any path
    with changes loses: a part of j other-language runs gains at most j half switches and pays
    j - 1 switches at least (a single run over the whole document is no better than the best).
    """
    best = int(scores.sum(axis=0, dtype=np.float64).argmax())
    gains = np.cumsum(scores - scores[:, best : best + 1], axis=0, dtype=np.float64)
    floor = np.minimum(np.minimum.accumulate(gains, axis=0), 0)
    floor[1:], floor[0] = floor[:-1].copy(), 0
    return best if (gains - floor).max() <= switch / 2 else None


def viterbi(many: list[np.ndarray], switch: float) -> list[np.ndarray]:
    """Best labels of several documents, word after word for all of them at once.

    Documents stand by falling length; step t holds the documents that have a word t. What must
    be remembered is one bit per word and language, and one language per word.
    """
    order = sorted(range(len(many)), key=lambda i: -len(many[i]))
    lengths = np.array([len(many[i]) for i in order])
    states = many[0].shape[1]
    active = len(many) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
    begins = np.concatenate(([0], np.cumsum(active)))
    steps = np.zeros((begins[-1], states), np.float32)
    for k, i in enumerate(order):
        steps[begins[: lengths[k]] + k] = many[i]
    stayed = np.ones((begins[-1], states), bool)
    came = np.zeros(begins[-1], np.int16)
    total = np.zeros((len(many), states))
    rows = np.arange(len(many))
    for t, (begin, n) in enumerate(zip(begins.tolist(), active.tolist(), strict=False)):
        now = total[:n]
        if t:
            best = now.argmax(axis=1)
            jump = (now[rows[:n], best] - switch)[:, None]
            stay = now >= jump
            stayed[begin : begin + n], came[begin : begin + n] = stay, best
            now = np.where(stay, now, jump)
        total[:n] = now + steps[begin : begin + n]
    labels = np.zeros(begins[-1], np.int16)
    state = total.argmax(axis=1).astype(np.int16)
    for t in range(len(active) - 1, -1, -1):
        begin, n = begins[t], active[t]
        now = state[:n]
        labels[begin : begin + n] = now
        kept = stayed[begin : begin + n][rows[:n], now]
        state[:n] = np.where(kept, now, came[begin : begin + n])
    out: list[np.ndarray] = [None] * len(many)
    for k, i in enumerate(order):
        out[i] = labels[begins[: lengths[k]] + k]
    return out


def label(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score and spans (first word, word behind the last, language) per row.

    Words are what white space parts. ``lang_pred`` has the most letters; ``score`` is its share
    of the letters, counting only words whose script some language uses. No letters, a null text
    or a model without languages: ``und``, 0, no spans. Very long texts are read whole. Repeated
    rows are judged each for itself; other columns are not read.
    """
    kind = kind_of(docs, "doc_id")
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())])

    def run(batches):
        judge = _judge(model, switch)
        for part in slices(batches):
            found = judge(part)
            columns = list(zip(*found, strict=True))
            kinds = (pa.string(), pa.float64(), pa.list_(span))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id")]
                + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "lang_pred", "score", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, lang_pred string, score double, "
        "spans array<struct<start: bigint, stop: bigint, lang: string>>",
    )


def _judge(model: Model, switch: float):
    letters = Letters()

    def judge(part: pa.RecordBatch) -> list[tuple]:
        numbers: dict[str, int] = {}
        number = numbers.setdefault
        ids = [
            np.array([number(w, len(numbers)) for w in (t or "").lower().split()], np.int64)
            for t in part.column("text").to_pylist()
        ]
        scores, n_letters, known = word_scores(model, letters, list(numbers))
        rows = _labelled([scores[i] for i in ids], switch) if model.languages else ids
        return [
            _summary(model, path, n_letters[i], known[i])
            for path, i in zip(rows, ids, strict=True)
        ]

    return judge


def known_language(
    docs: DataFrame,
    switch: float = SWITCH,
    most: int = TRAIN_DOCS,
    learned_scripts: bool = False,
) -> DataFrame:
    """The rows of ``docs`` whose text has a language; columns as in ``docs``.

    Rejected are texts without letters and null texts (all texts, if no language is learned);
    with ``learned_scripts`` also texts without a letter in a script of any learned language,
    whose score is 0.
    """
    model = train(docs, most)

    def run(batches):
        judge = _judge(model, switch)
        for part in slices(batches):
            kept = [
                lang != UNKNOWN and (score > 0 or not learned_scripts)
                for lang, score, _ in judge(part)
            ]
            yield part.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _labelled(many: list[np.ndarray], switch: float) -> list[np.ndarray]:
    paths: list[np.ndarray] = []
    mixed = []
    for i, scores in enumerate(many):
        single = one_language(scores, switch) if len(scores) else 0
        paths.append(np.full(len(scores), -1 if single is None else single, np.int16))
        if single is None:
            mixed.append(i)
    if mixed:
        for i, path in zip(mixed, viterbi([many[i] for i in mixed], switch), strict=True):
            paths[i] = path
    return paths


def _summary(model: Model, path: np.ndarray, n_letters: np.ndarray, known: np.ndarray):
    letters = int(n_letters.sum())
    if not letters or not model.languages:
        return UNKNOWN, 0.0, []
    weights = np.bincount(path, n_letters, len(model.languages))
    best = int(weights.argmax())
    surely = float((n_letters * known)[path == best].sum())
    cuts = np.flatnonzero(np.diff(path)) + 1
    starts, stops = [0, *cuts.tolist()], [*cuts.tolist(), len(path)]
    spans = [
        {"start": a, "stop": b, "lang": model.languages[path[a]]}
        for a, b in zip(starts, stops, strict=True)
    ]
    return model.languages[best], surely / letters, spans


def predict(docs: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score and spans of every row of ``docs`` (see ``label``)."""
    found = label(docs, train(docs, most))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "spans"
    )
