"""Mixing sources to target weights: Pfair windows for blocks, earliest deadline first."""

from __future__ import annotations

import heapq
from bisect import bisect_right
from dataclasses import dataclass
from fractions import Fraction
from itertools import accumulate
from math import ceil, lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketbars.llm.common import free_names, stored, text_key
from marketbars.session import work_dir

# A block is what one slot takes from one source.
BLOCK_WORDS = 4096
# Slots of a round at least; each round has whole quanta of its own.
QUANTA = 1000
# Sources with a lane of their own: those named, or else the largest. All others share one lane,
# in which they are mixed to their own weights.
MOST_SOURCES = 200
TEMPER = 0.5
# Rows numbered by one window at most, on average.
WINDOW_ROWS = 20_000
SEED = 7
REST = "rest"
WORD = r"[^\x20\x09-\x0D]+"


def quanta_of(weights: dict[str, float], quanta: int = QUANTA) -> dict[str, int]:
    """Whole quanta nearest to the weights (largest remainder), at least one each."""
    if not weights:
        return {}
    total = sum(weights.values())
    exact = {k: max(1.0, w / total * quanta) for k, w in weights.items()}
    found = {k: int(x) for k, x in exact.items()}
    left = max(0, quanta - sum(found.values()))
    for k in sorted(exact, key=lambda k: (found[k] - exact[k], k))[:left]:
        found[k] += 1
    return found


def pattern(quanta: dict[str, int]) -> dict[str, list[int]]:
    """The slots of each source in one period, as earliest deadline first fills them.

    Block i of a source with a of Q quanta is released at floor(i Q / a) and due at
    ceil((i + 1) Q / a). All weights together fill every slot, and each block has a slot inside
    its window: at any time a source is less than one block from its share.
    """
    period = sum(quanta.values())
    waiting = [(0, -(-period // a), k, 0) for k, a in quanta.items()]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots: dict[str, list[int]] = {k: [] for k in quanta}
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, due, k, i = heapq.heappop(waiting)
            heapq.heappush(ready, (due, k, i))
        _, k, i = heapq.heappop(ready)
        slots[k].append(slot)
        if i + 1 < quanta[k]:
            window = (i + 1) * period // quanta[k], -(-(i + 2) * period // quanta[k])
            heapq.heappush(waiting, (*window, k, i + 1))
    return slots


@dataclass(frozen=True)
class Stretch:
    """Blocks ``first`` up to ``stop`` of a source, placed while the same sources are left."""

    source: str
    phase: int
    first: int
    stop: int
    offset: int
    period: int
    quanta: int
    slots: list[int]


def phases(blocks: dict[str, int], quanta: dict[str, int]) -> list[Stretch]:
    """The schedule until all blocks are placed, by whole weights; ``exact_phases`` takes any.

    When a source is used up the others go on in proportion to their quanta. The period's
    pattern is worked out once per phase, whatever the number of blocks.
    """
    left = {k: n for k, n in blocks.items() if n}
    used = dict.fromkeys(left, 0)
    found: list[Stretch] = []
    offset = phase = 0
    while left:
        active = {k: quanta[k] for k in left}
        period, slots = sum(active.values()), pattern(active)

        def slot(k, i, period=period, slots=slots, active=active):
            return i // active[k] * period + slots[k][i % active[k]]

        end = min(slot(k, n) for k, n in left.items())
        for k in list(left):
            whole, rest = divmod(end, period)
            n = whole * active[k] + sum(s < rest for s in slots[k])
            if n:
                found.append(
                    Stretch(k, phase, used[k], used[k] + n, offset, period, active[k], slots[k])
                )
            used[k] += n
            left[k] -= n
            if not left[k]:
                del left[k]
        offset, phase = offset + end, phase + 1
    return found


def in_windows(
    windows: dict[str, list[tuple[int, int]]], first: int, stop: int
) -> dict[str, list[int]] | None:
    """The slot of every block, earliest deadline first; None if one misses its window."""
    waiting = [(w[0][0], w[0][1], k, 0) for k, w in windows.items() if w]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots: dict[str, list[int]] = {k: [] for k in windows}
    for slot in range(first, stop):
        while waiting and waiting[0][0] <= slot:
            _, due, k, i = heapq.heappop(waiting)
            heapq.heappush(ready, (due, k, i))
        if not ready or ready[0][0] <= slot:
            return None
        _, k, i = heapq.heappop(ready)
        slots[k].append(slot)
        if i + 1 < len(windows[k]):
            heapq.heappush(waiting, (*windows[k][i + 1], k, i + 1))
    return slots


@dataclass(frozen=True)
class Phase:
    """``length`` slots in which the same sources are left, cut into rounds.

    Source k's share of a slot is exactly ``parts[k] / whole``; ``used[k]`` of its blocks lie in
    earlier phases, and ``last`` is used up at the end.
    """

    number: int
    offset: int
    length: int
    slots: int
    parts: dict[str, int]
    whole: int
    used: dict[str, int]
    last: str

    @property
    def rounds(self) -> int:
        return max(1, self.length // self.slots)

    def start(self, turn: int) -> int:
        return self.length if turn == self.rounds else turn * self.slots

    def given(self, turn: int) -> dict[str, int]:
        """Blocks before a round: the exact shares, with the largest remainders rounded up.

        No round gives a source less than none: with ``slots`` of at least one over its share,
        the lower number behind a round is the higher one before it, or more.
        """
        t = self.start(turn)
        found = {k: a * t // self.whole for k, a in self.parts.items()}
        ends = turn == self.rounds

        def rank(k):
            return not (ends and k == self.last), -(self.parts[k] * t % self.whole), k

        # Only remainders are rounded up, and there are more of them than blocks missing.
        open_ = [k for k in found if self.parts[k] * t % self.whole]
        for k in sorted(open_, key=rank)[: t - sum(found.values())]:
            found[k] += 1
        return found

    def blocks(self, turn: int) -> list[tuple[str, int, int, int, int, int]]:
        """Source, block, phase, release, deadline and slot of each block of a round."""
        before, after = self.given(turn), self.given(turn + 1)
        first, stop = self.start(turn), self.start(turn + 1)
        windows = {
            k: [
                (
                    max(first, i * self.whole // a),
                    min(stop, -(-(i + 1) * self.whole // a)),
                )
                for i in range(before[k], after[k])
            ]
            for k, a in self.parts.items()
        }
        placed = in_windows(windows, first, stop)
        if placed is None:
            # The whole quanta of the round always fit, at less than one block more.
            quanta = {k: len(w) for k, w in windows.items() if w}
            n = stop - first
            windows = {
                k: [(first + i * n // a, first - (-(i + 1) * n // a)) for i in range(a)]
                for k, a in quanta.items()
            }
            placed = {k: [first + t for t in slots] for k, slots in pattern(quanta).items()}
        return [
            (
                k,
                self.used[k] + before[k] + i,
                self.number,
                self.offset + windows[k][i][0],
                self.offset + windows[k][i][1],
                self.offset + slot,
            )
            for k, slots in placed.items()
            for i, slot in enumerate(slots)
        ]


def exact_phases(
    blocks: dict[str, int], weights: dict[str, float], quanta: int = QUANTA
) -> list[Phase]:
    """The schedule until all blocks are placed, by the weights as they are.

    Block i of a source of share w is released at floor(i / w) and due at ceil((i + 1) / w), so
    that at any time a source is less than one block from its exact share of the phase's slots,
    however many there are. A round in which these windows cannot all be met keeps its number of
    blocks, and the bound is one block behind it and two inside. A phase ends when a source is
    used up. Sources of no weight follow when all others are used up.
    """
    left = {k: n for k, n in blocks.items() if n}
    used = dict.fromkeys(left, 0)
    found: list[Phase] = []
    offset = 0
    while left:
        exact = {k: Fraction(weights[k]) for k in left if weights[k] > 0}
        exact = exact or dict.fromkeys(left, Fraction(1))
        common = lcm(*(w.denominator for w in exact.values()))
        parts = {k: int(w * common) for k, w in exact.items()}
        whole = sum(parts.values())
        last = min(parts, key=lambda k: (Fraction(left[k], parts[k]), k))
        length = left[last] * whole // parts[last]
        slots = max(quanta, ceil(Fraction(whole, min(parts.values()))))
        phase = Phase(len(found), offset, length, slots, parts, whole, dict(used), last)
        found.append(phase)
        for k, n in phase.given(phase.rounds).items():
            used[k] += n
            left[k] -= n
            if not left[k]:
                del left[k]
        offset += length
    return found


def placed_blocks(spark, plan: list[Phase]) -> DataFrame:
    """lane, block, phase, release, deadline and slot of all blocks: a row for each, in Spark."""
    schema = "lane string, block bigint, phase int, release bigint, deadline bigint, slot bigint"
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    names = ["lane", "block", "phase", "release", "deadline", "slot"]
    ends = list(accumulate(p.rounds for p in plan))

    def run(batches):
        for batch in batches:
            for turn in batch.column("id").to_pylist():
                n = bisect_right(ends, turn)
                columns = zip(*plan[n].blocks(turn - (ends[n - 1] if n else 0)), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names
                )

    return spark.range(ends[-1] if ends else 0).mapInArrow(run, schema)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def lane_of(source: Column) -> Column:
    """A name that keeps a null source apart from every other."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _rest(rows: DataFrame, shared: DataFrame, buckets: int) -> DataFrame:
    """Rows of the lane of all other sources, in an order that mixes those to their weights.

    A row's turn is the middle of its words among its source's, over the source's weight. In that
    order all sources are at the same turn at any time, each within one row of its weight times
    that turn, whatever their number; used up ones drop out and the others go on in proportion.
    """
    amount = F.col("n_words") * F.col("copies")
    sums = rows.groupBy("name", "bucket").agg(F.sum(amount).alias("amount"))
    earlier = W.partitionBy("name").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select(
        "name", "bucket", F.coalesce(F.sum("amount").over(earlier), F.lit(0)).alias("base")
    )
    inside = W.partitionBy("name", "bucket").orderBy("key", "doc_id", "text_key", "source")
    running = F.sum(amount).over(inside.rowsBetween(W.unboundedPreceding, -1))
    # A weight of 0: behind all others, as ``exact_phases`` has it.
    pace = F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(1e-300))
    turned = (
        rows.drop("turn")
        .join(bases, ["name", "bucket"])
        .join(shared.select("name", "weight"), "name")
        .withColumn("turn", (F.col("base") + F.coalesce(running, F.lit(0)) + amount / 2) / pace)
    )
    order = ["turn", "key", "doc_id", "text_key", "source"]
    dealt = turned.repartitionByRange(buckets + 1, *order)
    # Stored by the caller: bounds drawn again would be others.
    return dealt.withColumn("bucket", F.spark_partition_id().cast("bigint")).select(*rows.columns)


def schedule(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    quanta: int = QUANTA,
    block_words: int = BLOCK_WORDS,
    window_rows: int = WINDOW_ROWS,
    most_sources: int = MOST_SOURCES,
) -> DataFrame:
    """One row per different (doc_id, text, source): its block, its window and its slot.

    Blocks are placed by the exact weights, see ``exact_phases``; ``quanta`` is the slots of a
    round. Documents of a source follow each other by a hash; every ``block_words`` words of the source
    make a block, and a document belongs to the block its first word lies in. ``weights`` gives
    the target share of sources by name, all of which get lanes of their own; without it they go
    by the square root of their words, the ``most_sources`` largest in lanes of their own. All
    others share the lane ``rest``, which has the sum of their weights (a source not named has the
    least named weight; ``rest`` named, they have that weight together), and are mixed to their
    weights inside it, see ``_rest``. ``copies`` counts repeated rows, which share the
    first one's block. A null source is a source of its own; a null text has no words. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "mixing")
    (
        docs.select(
            "doc_id",
            text_key().alias("text_key"),
            lane_of(F.col("source")).alias("name"),
            "source",
            n_words(F.col("text")).alias("n_words"),
        )
        .groupBy("doc_id", "text_key", "name", "source", "n_words")
        .agg(F.count("*").alias("copies"))
        .write.parquet(folder)
    )
    rows = spark.read.parquet(folder).withColumn(
        "key", F.xxhash64("doc_id", "text_key", F.lit(SEED))
    )
    amount = F.sum(F.col("n_words") * F.col("copies"))
    by_name = rows.groupBy("name").agg(amount.alias("amount"))
    # As many rows as there are lanes at most.
    if weights is not None:
        wanted = {f"={k}": w for k, w in weights.items() if k != REST}
        own = by_name.filter(F.col("name").isin(list(wanted)))
        shares = {r["name"]: wanted[r["name"]] for r in own.collect()}
        each = F.lit(float(min(weights.values(), default=1.0)))
    else:
        own = by_name.orderBy(F.desc("amount"), "name").limit(most_sources)
        shares = {r["name"]: max(1, r["amount"]) ** TEMPER for r in own.collect()}
        each = F.greatest(F.col("amount"), F.lit(1)) ** TEMPER
    named = sorted(shares)
    shared = by_name.filter(~F.col("name").isin(named)).withColumn("weight", each)
    rest = shared.agg(F.sum("weight").alias("weight"), F.count("*").alias("n")).first()
    shares[REST] = rest["weight"] or 0.0
    if weights is not None and REST in weights:
        shares[REST] = weights[REST]
    lane = F.when(F.col("name").isin(named), F.col("name")).otherwise(REST)
    total = rows.count()
    bits = max(0, (total // max(1, window_rows)).bit_length())
    bucket = F.shiftrightunsigned("key", 64 - bits).cast("bigint") if bits else F.lit(0)
    laned = rows.withColumn("lane", lane).withColumn("bucket", bucket).withColumn("turn", F.lit(0.0))
    if rest["n"] > 1:
        mixed_rest = _rest(laned.filter(F.col("lane") == REST), shared, total // max(1, window_rows))
        laned = laned.filter(F.col("lane") != REST).unionByName(stored(mixed_rest, f"{folder}-rest"))
    sums = laned.groupBy("lane", "bucket").agg(amount.alias("amount"))
    earlier = W.partitionBy("lane").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select(
        "lane", "bucket", F.coalesce(F.sum("amount").over(earlier), F.lit(0)).alias("base")
    )
    by_lane = sums.groupBy("lane").agg(F.sum("amount").alias("amount"))
    lanes = {r["lane"]: r["amount"] for r in by_lane.collect()}
    blocks = {k: max(1, -(-n // block_words)) for k, n in lanes.items()}
    plan = exact_phases(blocks, {k: shares[k] for k in sorted(lanes)}, quanta)
    # Written first: a join then knows how large it is, and shuffles what is too large to send.
    placed = stored(placed_blocks(spark, plan), f"{folder}-placed")
    of_lane = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])
    last_block = F.element_at(of_lane, F.col("lane")) - 1 if blocks else F.lit(0)
    inside = W.partitionBy("lane", "bucket").orderBy("turn", "key", "doc_id", "text_key", "source")
    running = F.sum(F.col("n_words") * F.col("copies")).over(
        inside.rowsBetween(W.unboundedPreceding, -1)
    )
    numbered = (
        laned.join(bases, ["lane", "bucket"])
        .withColumn("start", F.col("base") + F.coalesce(running, F.lit(0)))
        # Behind a lane's last word (documents without words): still its last block.
        .withColumn(
            "block",
            F.least(F.floor(F.col("start") / block_words), last_block).cast("bigint"),
        )
    )
    return numbered.join(placed, ["lane", "block"]).select(
        "doc_id",
        "text_key",
        "source",
        "n_words",
        "copies",
        "lane",
        "phase",
        "block",
        "start",
        "release",
        "deadline",
        "slot",
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, n_words, block, release, deadline, slot."""
    found = schedule(docs, **options)
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(
        "doc_id", "source", "n_words", "phase", "block", "release", "deadline", "slot"
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """All rows of ``docs``, sorted over all partitions by slot, then by place in the source."""
    names = free_names(docs, "of_id", "of_text", "of_lane", "slot", "start")
    of_id, of_text, of_source, slot, start = names
    placed = schedule(docs, **options).select(
        F.struct(F.isnull("doc_id"), "doc_id").alias(of_id),
        F.col("text_key").alias(of_text),
        lane_of(F.col("source")).alias(of_source),
        F.col("slot").alias(slot),
        F.col("start").alias(start),
    )
    keyed = docs.withColumns(
        {
            of_id: F.struct(F.isnull("doc_id"), "doc_id"),
            of_text: text_key(),
            of_source: lane_of(F.col("source")),
        }
    )
    joined = keyed.join(placed, [of_id, of_text, of_source])
    return (
        joined.repartitionByRange(slot, start, of_text)
        .sortWithinPartitions(slot, start, of_text)
        .select(*docs.columns)
    )
