"""Benchmark decontamination by spaced seeds, in DataFrame functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import free_names, text_key

# 1: this word is hashed; 0: it may be any word. Any 13 words with two substitutions hold a
# place where one of the two masks meets none of them (tests/llm tries them all).
MASKS = ("1111011", "111010011")
# Words of an aligned stretch, and the share of them that must be equal.
STRETCH = 13
SHARE = 0.8
# Items of at least so many words are looked up by the masks above.
LEAST_WORDS = max(map(len, MASKS))
# Items shorter than a stretch are looked up by these as well: from seven words on, with as many
# substitutions as the share allows, a place is left where a mask meets none (tests/llm tries all).
SHORT_MASKS = ("10111", "1111")
LEAST_SHORT = 7
# Still shorter items must occur whole. Those of fewer words are everyday phrases: they are looked
# up and reported where it is asked for, and take no document away.
LEAST_WHOLE = 4
# Item words that are verified at once.
PIECE = 64
# Benchmark seeds that may be broadcast (about 50 bytes each); beyond, the join shuffles.
BROADCAST_SEEDS = 500_000


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def seeds(words: Column, at: Column, masks=MASKS) -> Column:
    """The hash of the words each mask looks at from ``at`` on; null where it passes the end.

    Runs of looked-at words are cut out as slices: word by word, the generated code would be too
    long for the JVM to compile.
    """
    found = []
    for number, mask in enumerate(masks):
        runs = [(m.start(), m.end() - m.start()) for m in re.finditer("1+", mask)]
        looked = F.concat(*[F.slice(words, at + start + 1, F.lit(n)) for start, n in runs])
        inside = at + len(mask) <= F.size(words)
        found.append(F.when(inside, F.xxhash64(F.lit(number), looked)))
    return F.array(*found)


def _placed(rows: DataFrame, words: str, place: str, seed: str, masks) -> DataFrame:
    """One row for each word position and mask."""
    ready = rows.filter(F.size(words) >= min(map(len, masks)))
    at = ready.withColumn(place, F.explode(F.sequence(F.lit(0), F.size(words) - 1)))
    return at.withColumn(seed, F.explode(seeds(F.col(words), F.col(place), masks))).filter(
        F.col(seed).isNotNull()
    )


def matches(words: Column, item: Column) -> Column:
    """A string with 1 for each equal pair of words of two stretches of the same length."""
    equal = F.zip_with(words, item, lambda w, i: F.when(w == i, "1").otherwise("0"))
    return F.array_join(equal, "")


def best_stretch(equal: Column, stretch: Column) -> Column:
    """Most equal words in ``stretch`` words in a row."""
    starts = F.sequence(F.lit(1), F.length(equal) - stretch + 1)
    counts = F.transform(
        starts, lambda s: F.length(F.replace(F.substr(equal, s, stretch), F.lit("0"), F.lit("")))
    )
    return F.when(F.length(equal) >= stretch, F.array_max(counts)).otherwise(0)


def _laid(hits: DataFrame, stretch: int, masks) -> DataFrame:
    """The words of document and item around a piece, as far as both go, and what must agree."""
    reach = stretch + max(map(len, masks))
    shift, piece = F.col("shift"), F.col("piece")
    first = F.greatest(F.lit(0), piece * PIECE - reach, -shift)
    stop = F.least(F.size("item"), (piece + 1) * PIECE + reach, F.size("words") - shift)
    return hits.withColumns(
        {
            "length": F.least(F.lit(stretch), F.size("item")),
            "found": F.slice("words", first + shift + 1, stop - first),
            "given": F.slice("item", first + 1, stop - first),
        }
    ).drop("words", "item")


def _items(benchmark: DataFrame) -> DataFrame:
    return (
        benchmark.select("item_id", words_of(F.col("text")).alias("item"))
        .distinct()
        .withColumn("item_key", F.xxhash64("item_id", "item"))
    )


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    masks=MASKS,
    stretch: int = STRETCH,
    share: float = SHARE,
    broadcast_seeds: int = BROADCAST_SEEDS,
    least_whole: int = LEAST_WHOLE,
) -> DataFrame:
    """(doc_id, text_key, item_id) of benchmark passages found in documents, with their extent.

    Masks ignore fixed word positions, so that a hash survives substitutions there. Equal hashes
    of a document and an item lay the item along the document; the pair counts if, around the
    hit, ``stretch`` words in a row (the whole item, if that is shorter) have at least ``share``
    equal words. ``first_word`` and ``last_word`` bound the hits in the document, in words of
    letters and digits; ``n_equal`` is the best stretch's count.

    Items of 7 words up to a stretch are looked up by ``SHORT_MASKS`` too, which miss none; what
    the masks find already stays as they report it. Items of ``least_whole`` to 6 words must occur
    whole. Null and empty texts and items of fewer words match nothing. Repeated rows of
    either table give one row per pair. A null doc_id or item_id is reported as null. An empty
    table gives no rows; other columns are not read.
    """
    items = _items(benchmark)
    size = F.size("item")
    long = items.filter(size >= max(map(len, masks)))
    found = _found(docs, long, masks, stretch, share, broadcast_seeds)
    # Documents are read again only for lengths that the benchmark holds.
    brief = items.filter((size >= max(1, least_whole)) & (size < stretch))
    lengths = {r["n"] for r in brief.select(size.alias("n")).distinct().collect()}
    more = []
    if any(n >= LEAST_SHORT for n in lengths):
        some = brief.filter(size >= LEAST_SHORT)
        more.append(_found(docs, some, SHORT_MASKS, stretch, share, broadcast_seeds))
    for n in sorted(n for n in lengths if n < LEAST_SHORT):
        whole = brief.filter(size == n)
        more.append(_found(docs, whole, ("1" * n,), stretch, 1.0, broadcast_seeds))
    if not more:
        return found
    ranked = found.withColumn("rank", F.lit(0))
    for other in more:
        ranked = ranked.unionByName(other.withColumn("rank", F.lit(1)))
    keys = ["doc_id", "text_key", "item_id"]
    extent = F.struct(*[c for c in found.columns if c not in keys])
    best = ranked.groupBy(*keys).agg(F.min_by(extent, F.struct("rank", extent)).alias("best"))
    return best.select(*keys, "best.*")


def _found(
    docs: DataFrame, items: DataFrame, masks, stretch: int, share: float, broadcast_seeds: int
) -> DataFrame:
    """What ``leaks`` returns, for items looked up by ``masks``."""
    probes = _placed(items, "item", "item_at", "seed", masks)
    rows = docs.select(
        "doc_id", text_key().alias("text_key"), words_of(F.col("text")).alias("words")
    )
    placed = _placed(rows, "words", "at", "seed", masks)
    shift = (F.col("at") - F.col("item_at")).alias("shift")
    piece = F.floor(F.col("item_at") / PIECE).cast("int").alias("piece")
    keys = ["doc_id", "text_key", "item_id", "item_key", "shift", "piece"]
    extent = [
        F.min("at").alias("from"),
        F.max("at").alias("to"),
        F.count("*").alias("hits"),
    ]
    # Hits on one diagonal are verified together, piece by piece of the item, with what lies
    # around: aggregated before the comparison, which is no part of the compiled join then.
    of_item = items.select("item_key", "item")
    narrow = probes.select("seed", "item_id", "item_key", "item_at")
    if narrow.count() <= broadcast_seeds:
        # A word begins two seeds at most, so that the items' words are as bounded.
        hits = (
            placed.join(F.broadcast(narrow), "seed")
            .join(F.broadcast(of_item), "item_key")
            .select(*keys[:4], shift, piece, "at", "words", "item")
        )
        laid = _laid(hits, stretch, masks).groupBy(*keys, "length").agg(
            *extent, F.first("found").alias("found"), F.first("given").alias("given")
        )
    else:
        # Words stay behind: only places travel to the seeds and back to their documents.
        met = (
            placed.select("seed", "doc_id", "text_key", "at")
            .join(narrow, "seed")
            .select(*keys[:4], shift, piece, "at")
            .groupBy(*keys)
            .agg(*extent)
        )
        texts = rows.groupBy("doc_id", "text_key").agg(F.first("words").alias("words")).select(
            F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_text"), "words"
        )
        same = met["doc_id"].eqNullSafe(texts["of_id"]) & (met["text_key"] == texts["of_text"])
        laid = _laid(met.join(of_item, "item_key").join(texts, same), stretch, masks)
    verified = (
        laid.withColumn("equal", matches(F.col("found"), F.col("given")))
        .withColumn("n_equal", best_stretch(F.col("equal"), F.col("length")))
        .filter(F.col("n_equal") >= F.ceil(F.col("length") * F.lit(share)))
    )
    return verified.groupBy("doc_id", "text_key", "item_id").agg(
        F.min("from").alias("first_word"),
        (F.max("to") + min(map(len, masks)) - 1).alias("last_word"),
        F.max("n_equal").cast("bigint").alias("n_equal"),
        F.sum("hits").alias("n_hits"),
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, least_whole: int = 1) -> DataFrame:
    """One row per document and benchmark item found in it, items of one word included.

    A report: see ``leaks``. Which of it takes documents away is up to ``without_leaks``.
    """
    found = leaks(docs, benchmark, least_whole=least_whole)
    return found.groupBy("doc_id", "item_id").agg(
        F.min("first_word").alias("first_word"),
        F.max("last_word").alias("last_word"),
        F.max("n_equal").alias("n_equal"),
        F.sum("n_hits").alias("n_hits"),
    )


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, least_whole: int = LEAST_WHOLE
) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item of ``least_whole`` words or more is found.

    Columns as in ``docs``.
    """
    id_name, text_name = free_names(docs, "found_id", "found_text")
    found = leaks(docs, benchmark, least_whole=least_whole).select(
        F.col("doc_id").alias(id_name), F.col("text_key").alias(text_name)
    )
    marked = docs.withColumn(text_name + "_of", text_key())
    same = (marked[text_name + "_of"] == found[text_name]) & marked["doc_id"].eqNullSafe(
        found[id_name]
    )
    return marked.join(found.distinct(), same, "left_anti").select(*docs.columns)
