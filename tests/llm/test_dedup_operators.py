"""SimHash near-dedup, substring dedup, line dedup against brute force."""

import collections
import itertools
import random

import pytest
from frames import ODD, PROSE, brute_fingerprint, brute_groups, brute_windows, clashing, frame, row
from pyspark.sql import functions as F

from marketbars.llm import components, linechunks, simhash, superkmers


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def near_numbers(seed, n=60, centres=6):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(centres)] + [0, (1 << 64) - 1]
    out = set(base)
    while len(out) < n:
        value = rng.choice(sorted(out))
        for _ in range(rng.randint(1, 4)):
            value ^= 1 << rng.randrange(64)
        out.add(value)
    return sorted(out)


@pytest.mark.parametrize("text", ["", " ", "One", "one TWO", "A b c", PROSE, "É é É é x " * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(PROSE.encode()) == brute_fingerprint(PROSE)


@pytest.mark.parametrize("paired", [64, 2, 0])
@pytest.mark.parametrize("most,segments", [(2, 16), (2, 4), (1, 8)])
def test_links_join_what_distance_joins(spark, paired, most, segments):
    values = near_numbers(paired + segments)
    prints = spark.createDataFrame([(signed(v),) for v in values], "print bigint")
    edges = simhash.links(prints, most, segments, paired)
    for u, v in edges.collect():
        assert bin((u ^ v) & (1 << 64) - 1).count("1") <= (2 if paired < 64 else most)
    found = {r.node: r.root for r in components.components(edges).collect()}
    expected = brute_groups(values, most)
    members = collections.defaultdict(set)
    for v in values:
        members[expected[v]].add(signed(v))
    for group in members.values():
        assert {found.get(v, v) for v in group} == {min(group)}


def test_budgets_are_proportional():
    assert simhash.budgets(4, 2) == [0, 1, 1, 2]
    assert simhash.budgets(16, 2) == [0] * 7 + [1] * 8 + [2]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (5, 5), (7, 6)]
    got = components.components(spark.createDataFrame(edges, "u bigint, v bigint"))
    expected = {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}
    assert {r.node: r.root for r in got.collect()} == expected
    none = components.components(spark.createDataFrame([], "u bigint, v bigint"))
    assert none.collect() == []


def test_near_duplicates_of_odd_rows(spark):
    expected = brute_groups([brute_fingerprint(r[1]) for r in ODD], 2)
    ids = collections.defaultdict(list)
    for r in ODD:
        if r[0] is not None:
            ids[expected[brute_fingerprint(r[1])]].append(r[0])
    want = collections.Counter()
    for r in ODD:
        mark = brute_fingerprint(r[1])
        want[r[0], f"{mark:016x}", min(ids[expected[mark]], default=None)] += 1
    got = simhash.near_duplicates(clashing(frame(spark, ODD)))
    assert collections.Counter(map(tuple, got.collect())) == want


def test_one_of_each_group_stays(spark):
    docs = clashing(frame(spark, ODD))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.select("doc_id", "text").collect()
    marks = [brute_fingerprint(r.text) for r in rows]
    root = brute_groups([brute_fingerprint(r[1]) for r in ODD], 2)
    assert len({root[m] for m in marks}) == len(marks) == len(set(root.values()))
    assert sorted(r.doc_id for r in rows)[0] == 1 and 2 not in [
        r.doc_id for r in rows if r.text == PROSE
    ]


def test_a_null_id_stays_only_alone(spark):
    rows = [row(None, "alpha beta gamma delta"), row(None, "zeta"), row(4, "zeta")]
    kept = simhash.keep_one(frame(spark, rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=str) == [(4, "zeta"), (None, "alpha beta gamma delta")]


@pytest.mark.parametrize(
    "bucket,chunk", [(1000, 20_000), (1000, 1), (12, 50), (2, 20_000), (0, 20_000)]
)
def test_windows_against_brute_force(spark, bucket, chunk):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(12)]
    rows = [row(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(40)]
    shared = " ".join(rng.choices(vocabulary, k=30))
    rows += [row(100 + i, f"{i} {i} {shared} {i} {shared[: 10 * i]}") for i in range(9)]
    rows += [row(50, "a b a b a b a b a b a b a b"), row(51, "a b " * 9), row(52, "a " * 30)] + ODD
    got = superkmers.dedup(frame(spark, rows), window=6, size=3, bucket=bucket, chunk=chunk)
    found = collections.Counter(
        (r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()
    )
    assert found == brute_windows(rows, 6)


def test_windows_of_production_size(spark):
    got = superkmers.dedup(clashing(frame(spark, ODD)))
    found = collections.Counter(
        (r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()
    )
    assert found == brute_windows(ODD, superkmers.WINDOW)


def brute_lines(rows, join=linechunks.JOIN):
    """Per text: what is left, number of lines, number removed."""
    last = (1 << 63) - 1
    keyed = {}
    for doc_id, text, *_ in rows:
        keyed[last if doc_id is None else doc_id, text] = None
    places, out = {}, {}
    chunked = {
        key: linechunks.chunks(None if key[1] is None else key[1].encode(), 1, join)
        for key in keyed
    }
    # Texts under one id go by their hash; the tests have none there that share a chunk.
    for key, parts in sorted(chunked.items(), key=lambda x: (x[0][0], x[0][1] or "")):
        for start, _, body in parts:
            places.setdefault(body, (key, start))
    for key, parts in chunked.items():
        if key[1] is None:
            out[key] = None, 0, 0
            continue
        lines, gone = key[1].split("\n"), set()
        for start, stop, body in parts:
            (other, at), shift = places[body], start - places[body][1]
            if (key, start) == (other, at):
                continue
            others = other[1].split("\n")

            def equal(i, others=others, shift=shift):
                return 0 <= i < len(lines) and 0 <= i - shift < len(others) and (
                    lines[i] == others[i - shift]
                )

            low, high = start, stop
            while equal(low - 1):
                low -= 1
            while equal(high):
                high += 1
            if high - low > 1:
                gone |= set(range(low, high))
        kept = [line for i, line in enumerate(lines) if i not in gone]
        out[key] = "\n".join(kept), len(lines), len(gone)
    return out


def test_shared_runs_of_lines_are_found(spark):
    """Nine in ten lines of passages that texts share with earlier ones, two lines or longer."""
    rng = random.Random(9)

    def fresh(n):
        return [f"line {rng.getrandbits(60)}" for _ in range(n)]

    passages = [fresh(rng.randint(2, 5)) for _ in range(80)]
    rows, shared = [], {}
    for i in range(400):
        passage = passages[i % 80]
        head = fresh(rng.randint(0, 5))
        rows.append(row(i, "\n".join(head + passage + fresh(rng.randint(0, 5)))))
        shared[i] = set(range(len(head), len(head) + len(passage)))
    gone = {r.doc_id: set(r.removed) for r in linechunks.dedup_lines(frame(spark, rows)).collect()}
    # Nothing that occurs once goes, and first copies stay.
    assert all(not gone[i] for i in range(80))
    assert all(gone[i] <= shared[i] for i in gone)
    wanted = sum(len(shared[i]) for i in range(80, 400))
    assert sum(len(gone[i]) for i in range(80, 400)) >= 0.9 * wanted


def test_lines_against_brute_force(spark):
    rng = random.Random(5)
    lines = [f"line {i}" for i in range(30)] + ["", "", "same"]
    rows = [row(i, "\n".join(rng.choices(lines, k=rng.randint(1, 40)))) for i in range(30)]
    block = "\n".join(f"shared {i}" for i in range(12))
    rows += [row(60 + i, f"own {i}\n" * i + block + f"\nend {i}") for i in range(8)]
    rows += [row(None, block), row(3, None), row(70, ""), row(71, "\n\n\n\n"), row(61, rows[31][1])]
    expected = brute_lines(rows)
    last = (1 << 63) - 1
    got = linechunks.dedup_lines(clashing(frame(spark, rows)))
    want = collections.Counter(
        (r[0], *expected[last if r[0] is None else r[0], r[1]]) for r in rows
    )
    found = collections.Counter(
        (r.doc_id, r.kept_text, r.n_lines, r.n_removed) for r in got.collect()
    )
    assert found == want
    assert sum(r[3] * n for r, n in found.items()) > 50


def test_boundaries_resist_shifts():
    lines = [f"text {i}".encode() for i in range(200)]
    ends = linechunks.cuts(lines)
    plain = {tuple(lines[a:b]) for a, b in zip([0, *ends], ends, strict=False)}
    moved = [b"new", *lines[:90], b"inserted", *lines[90:]]
    ends = linechunks.cuts(moved)
    again = {tuple(moved[a:b]) for a, b in zip([0, *ends], ends, strict=False)}
    assert len(plain & again) > 0.8 * len(plain)


@pytest.mark.parametrize("bucket", [5, 100_000])
def test_large_groups_of_exact_and_of_near_copies(spark, bucket):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    exact, near = rng.choices(vocabulary, k=80), rng.choices(vocabulary, k=80)
    rows = [row(100 + i, rng.choice([" ", "\n", " \t"]).join(exact)) for i in range(60)]
    for i in range(60):
        other = list(near)
        other[rng.randrange(80)] = f"x{i % 3}"
        rows.append(row(300 + i, " ".join(other)))
    # Copies within one document, under one id, without an id, and too short for a window.
    rows += [row(90, " ".join(exact[20:60])), row(91, " ".join(exact + exact)), row(92, "a b")]
    rows += [row(92, " ".join(exact)), row(None, " ".join(near)), row(93, "a b")]
    rows += [row(None, " ".join(exact))] * 2
    rng.shuffle(rows)
    got = superkmers.dedup(frame(spark, rows), window=10, size=3, bucket=bucket, chunk=50)
    found = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect())
    assert found == brute_windows(rows, 10)


def test_only_the_first_of_equal_texts_sends_super_k_mers(spark, monkeypatch):
    seen = []
    cut = superkmers.super_kmers

    def watched(docs, *args):
        seen.extend(r.id for r in docs.select("id").collect())
        return cut(docs, *args)

    monkeypatch.setattr(superkmers, "super_kmers", watched)
    rows = [row(i, PROSE + " " * i) for i in range(40)] + [row(50, "one two")]
    got = {r.doc_id: r.n_removed for r in superkmers.dedup(frame(spark, rows)).collect()}
    n_words = len(PROSE.split())
    assert got == {0: 0, 50: 0} | {i: n_words for i in range(1, 40)}
    assert sorted(seen) == [0, 50]


def test_a_text_sends_equal_super_k_mers_once_with_their_places(spark):
    round_texts = ["a b " * 200, "x " + "a b c " * 90, PROSE, " ".join([PROSE] * 3), "a b"]
    docs = frame(spark, [row(i, t) for i, t in enumerate(round_texts)])
    keyed = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_key"), "text")
    rows = superkmers.super_kmers(keyed).collect()
    assert len({(r.id, r.high, r.low) for r in rows}) == len(rows)
    for i, text in enumerate(round_texts):
        spans = [(p, r.n) for r in rows if r.id == i for p in r.places]
        ends = {k for p, n in spans for e in p for k in range(e, e + n)}
        between = {k for p, n in spans for k in range(p.first, p.last + n)}
        windows = set(range(max(0, len(text.split()) - superkmers.WINDOW + 1)))
        assert between == windows and ends <= windows
        for r in rows:
            held = r.places
            assert all(p.first <= p.last for p in held)
            assert all(q.first - p.last > superkmers.WINDOW for p, q in itertools.pairwise(held))
    assert sum(len(r.places) for r in rows if r.id == 3) > len([r for r in rows if r.id == 3])
    assert len([r for r in rows if r.id == 0]) <= 4


@pytest.mark.parametrize("bucket", [0, 5, 100_000])
def test_joined_rows_do_not_grow_with_repeats_in_a_text(spark, monkeypatch, bucket):
    judged, joined = superkmers._judged, []

    def watched(rows, folder):
        found = judged(rows, folder)
        joined[-1] += found.count()
        return found

    monkeypatch.setattr(superkmers, "_judged", watched)
    for times in (20, 200):
        joined.append(0)
        rows = [row(i, f"s{i} {'a b ' * times}t{i} c d e f g h i j") for i in range(8)]
        rows += [row(20, f"a b {'a b c ' * times}"), row(21, f"{'b c a ' * times} {'a b ' * 9}")]
        got = superkmers.dedup(frame(spark, rows), window=10, size=3, bucket=bucket, chunk=9)
        found = collections.Counter(
            (r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()
        )
        assert found == brute_windows(rows, 10)
    assert joined[0] == joined[1] and (joined[0] > 0) == (bucket < 100)


@pytest.mark.parametrize(
    "operator", [simhash.near_duplicates, simhash.keep_one, superkmers.dedup, linechunks.dedup_lines]
)
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).collect() == []


def test_text_key_is_xxh64(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("abc"))).first()[0] is not None
