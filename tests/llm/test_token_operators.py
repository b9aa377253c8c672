"""Token files, separator scan, mixing, and the pipeline."""

import collections
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from frames import LONG, ODD, PROSE, brute_fingerprint, brute_groups, clashing, frame, row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketbars.llm import encode, mixing, separators, tokenfile
from marketbars.session import work_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


def reference(text, special_as_text=False):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = special_as_text
    return tokenizer.encode(text or "", add_special_tokens=False).ids


TEXTS = [
    "a<|endoftext|>b c <|startoftext|>",
    "x\x1cy z",
    "Ünïcode İstanbul ΣΑΣ. don't WE'LL 123abc ½ é é a ́b 漢字かな 😀 the.Cat THE. foo?!..",
    "ÉLÈVE, straße ÿÿ Ÿ ÅÄÖ; þorn ÞORN",
    "",
    None,
    " \x85 a\x0bb   c d ",
    "a" * 5000 + " " + "Zq" * 3000 + ".",
    PROSE,
    LONG[:20_000],
]


@pytest.mark.parametrize("special", [False, True])
@pytest.mark.parametrize("memory", [20, 400_000])
def test_ids_equal_those_of_whole_texts(special, memory):
    encoder = encode.WordEncoder(PATH, special_as_text=special, memory=memory)
    assert encoder.folds
    for _ in range(2):
        for text, got in zip(TEXTS, encoder.encode(TEXTS), strict=True):
            assert np.frombuffer(got, "<u4").tolist() == reference(text, special)


def test_a_word_is_remembered_once_as_it_came():
    encoder = encode.WordEncoder(PATH)
    letters = "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0xFF)]))
    text = f"Zqxjv, {letters} {letters[::-1]}. Éa Éb, éa"
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == reference(text)
    assert set(encoder.known) == set(text.split())
    # Those of the last generation are still at hand; older ones are let go.
    encoder.memory = 3
    for more in ("one two three four", "five six seven eight", "nine ten"):
        assert np.frombuffer(encoder.ids(more), "<u4").tolist() == reference(more)
    assert set(encoder.known.older) == {"five", "six", "seven", "eight"}
    assert not encoder.known.older.older


def test_a_tokenizer_that_joins_over_white_space_gets_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = encode.WordEncoder(path)
    assert not encoder.parts and not encoder.folds
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = False
    for text, got in zip(TEXTS, encoder.encode(TEXTS), strict=True):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == ids


# --- token-id files ----------------------------------------------------------------------


def test_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(tokenfile, "SHARD_BYTES", 2000)
    docs = clashing(frame(spark, ODD))
    files = tokenfile.write_token_files(docs, work_dir(spark, "t"), PATH, 1)
    got = tokenfile.read_documents(spark, files).collect()
    want = collections.Counter((r[0], tuple(reference(r[1]) + [1])) for r in ODD)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    rows = sorted(tokenfile.read_token_files(spark, files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in ODD if r[0] is not None)) + [None] * 2
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    ids = {zlib.crc32(np.array(t, "<u4").tobytes()) for _, t in want}
    assert {r.ids_crc32 for r in rows} == ids
    # One document alone, through the index.
    shard = files.manifest(spark).filter("n_docs > 0").first().path
    reader = tokenfile.ShardReader(shard, files.dictionary)
    assert reader.ids(0).tolist() in [list(t) for _, t in want]
    with pytest.raises(ValueError, match="another dictionary"):
        tokenfile.ShardReader(shard, b"other")


def test_a_trained_dictionary_and_many_documents(spark):
    rng = random.Random(8)
    words = PROSE.split()
    rows = [row(i, " ".join(rng.choices(words, k=rng.randint(0, 80)))) for i in range(600)]
    rng.shuffle(rows)
    got = tokenfile.token_files(frame(spark, rows), PATH, 1).orderBy("start").collect()
    at = 0
    for r, (doc_id, text, *_) in zip(got, sorted(rows), strict=True):
        ids = np.array(reference(text) + [1], "<u4")
        assert tuple(r) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_documents_reach_the_workers_by_few_rows(spark, monkeypatch):
    docs, seen = frame(spark, [row(1, "a b"), row(2, "c")]), []
    kind = type(docs.write)
    write, setting = kind.parquet, tokenfile.BATCH_SETTING
    before = spark.conf.get(setting)

    def watched(self, path, *args, **options):
        if path.endswith("/manifest"):
            seen.append(int(spark.conf.get(setting)))
        return write(self, path, *args, **options)

    monkeypatch.setattr(kind, "parquet", watched)
    assert tokenfile.token_files(docs, PATH, 1).count() == 2
    assert len(seen) == 1 and seen[0] <= 1000
    assert spark.conf.get(setting) == before


def test_files_of_an_empty_table(spark):
    assert tokenfile.token_files(frame(spark, []), PATH, 1).collect() == []


def test_ids_must_be_integers(spark):
    docs = frame(spark, ODD).withColumn("doc_id", F.col("doc_id").cast("string"))
    with pytest.raises(ValueError, match="integer"):
        tokenfile.token_files(docs, PATH, 1)


# --- separator scan ----------------------------------------------------------------------


def test_a_vocabulary_beyond_two_bytes(spark, tmp_path):
    from tokenizers import models, pre_tokenizers

    words = {f"w{i}": i for i in range(70_001)} | {"[unk]": 70_001, "[end]": 70_002}
    made = Tokenizer(models.WordLevel(words, unk_token="[unk]"))
    made.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    path = str(tmp_path / "words.json")
    made.save(path)
    # 70002 modulo 65536 is 4466: in two bytes, w4466 would end a document.
    rows = [row(1, "w4466 w70000 w4464"), row(2, "w4466"), row(3, None), row(4, "w5 other")]
    assert separators.width_of(path, 70_002) == 4
    counted = separators.document_token_counts(frame(spark, rows), path, 70_002).collect()
    assert {r.doc_id: r.n_tokens for r in counted} == {1: 3, 2: 1, 3: 0, 4: 2}
    folder = work_dir(spark, "narrow")
    with pytest.raises(Exception, match="does not fit 2 bytes"):
        separators.flat_files(frame(spark, rows), folder, path, 70_002, width=2)


def test_placed_blocks_are_measured_before_they_are_joined(spark):
    docs = frame(spark, [row(i, "a b c " * 50, source=str(i % 3)) for i in range(60)])
    files = mixing.schedule(docs, block_words=10).inputFiles()
    assert any("-placed/" in file for file in files)


def stored(spark, arrays, width):
    folder = work_dir(spark, "flat")
    system, path = separators.open_folder(folder)
    system.create_dir(path, recursive=True)
    names = []
    for i, ids in enumerate(arrays):
        names.append((f"{folder}/{i}.bin",))
        system, path = separators.open_folder(names[-1][0])
        with system.open_output_stream(path) as out:
            out.write(np.array(ids, f"<u{width}").tobytes())
    return spark.createDataFrame([*names, names[0], (None,)], "file string"), names


@pytest.mark.parametrize("width", [2, 4])
@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_separators_across_blocks(spark, width, block):
    rng = random.Random(block)
    arrays = [[rng.choice([5, 6, 7, 9]) for _ in range(n)] for n in (0, 1, 40, 41)]
    arrays += [[9], [9, 9, 9], [1] * 30, [1] * 20 + [9]]
    files, names = stored(spark, arrays, width)
    got = separators.token_counts(files, 9, width, block).collect()
    want = set()
    for (name,), ids in zip(names, arrays, strict=True):
        start = ordinal = 0
        for at, value in enumerate(ids):
            if value == 9:
                want.add((name, ordinal, start, at - start, True))
                start, ordinal = at + 1, ordinal + 1
        if start < len(ids):
            want.add((name, ordinal, start, len(ids) - start, False))
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_token_counts_of_documents(spark):
    got = separators.document_token_counts(clashing(frame(spark, ODD)), PATH, 49407).collect()
    want = collections.Counter((r[0], len(reference(r[1], True))) for r in ODD)
    assert collections.Counter((r.doc_id, r.n_tokens) for r in got) == want
    assert separators.document_token_counts(frame(spark, []), PATH, 49407).collect() == []


# --- mixing ------------------------------------------------------------------------------


@pytest.mark.parametrize("quanta", [{"a": 1}, {"a": 5, "b": 3, "c": 2}, {"a": 700, "b": 299, "c": 1}])
def test_every_block_is_in_its_window(quanta):
    slots = mixing.pattern(quanta)
    period = sum(quanta.values())
    assert sorted(s for x in slots.values() for s in x) == list(range(period))
    for k, a in quanta.items():
        for i, slot in enumerate(slots[k]):
            assert i * period // a <= slot < -(-(i + 1) * period // a)
        given = 0
        for t in range(period):
            given += t in set(slots[k])
            assert abs((t + 1) * a / period - given) < 1


def test_random_weights_deviate_by_less_than_a_block():
    rng = random.Random(9)
    for _ in range(20):
        quanta = {f"s{i}": rng.randint(1, 60) for i in range(rng.randint(1, 9))}
        blocks = {k: rng.randint(0, 300) for k in quanta}
        taken = collections.Counter()
        order = {}
        for s in mixing.phases(blocks, quanta):
            for i in range(s.stop - s.first):
                slot = s.offset + i // s.quanta * s.period + s.slots[i % s.quanta]
                assert slot not in order
                order[slot] = s.source, s
                taken[s.source] += 1
        assert taken == collections.Counter({k: n for k, n in blocks.items() if n})
        assert sorted(order) == list(range(sum(blocks.values())))
        given = collections.Counter()
        for slot in sorted(order):
            k, s = order[slot]
            given[k, s.phase] += 1
            if k == max(quanta, key=quanta.get):
                assert abs((slot + 1 - s.offset) * s.quanta / s.period - given[k, s.phase]) < 1


def test_quanta_are_whole_and_near():
    found = mixing.quanta_of({"a": 1, "b": 2, "c": 0.00001}, 100)
    assert sum(found.values()) in (100, 101) and found["c"] == 1 and found["b"] in (66, 67)
    assert mixing.quanta_of({}) == {}


def test_blocks_keep_to_the_unrounded_weights():
    rng = random.Random(4)
    given = {"thirds": dict.fromkeys("abc", 1.0), "small": {"a": 1.0, "b": 0.0003, "c": 0.7}}
    given |= {str(n): {f"s{i}": rng.random() ** 2 + 0.001 for i in range(n)} for n in (2, 9, 40)}
    for weights in given.values():
        total = sum(map(Fraction, weights.values()))
        plan = mixing.exact_phases({k: 3_000_000 for k in weights}, weights)
        first = plan[0]
        # Some early rounds, and the last ones of a phase of millions of blocks.
        for turn in (0, 1, first.rounds // 2, first.rounds - 1):
            taken = first.given(turn)
            for k, *_, slot in sorted(first.blocks(turn), key=lambda b: b[-1]):
                taken[k] += 1
                for j in weights:
                    assert abs(taken[j] - Fraction(weights[j]) / total * (slot + 1)) < 1
        assert sum(p.length for p in plan) == 3_000_000 * len(weights)


def test_every_block_is_placed_once_by_exact_weights():
    rng = random.Random(5)
    for _ in range(30):
        weights = {f"s{i}": rng.choice([0, rng.random() + 0.01]) for i in range(rng.randint(1, 9))}
        blocks = {k: rng.randint(0, 200) for k in weights}
        rows = [
            b
            for p in mixing.exact_phases(blocks, weights, 20)
            for turn in range(p.rounds)
            for b in p.blocks(turn)
        ]
        assert sorted((k, i) for k, i, *_ in rows) == sorted(
            (k, i) for k, n in blocks.items() for i in range(n)
        )
        assert sorted(b[-1] for b in rows) == list(range(len(rows)))
        assert all(release <= slot < due for *_, release, due, slot in rows)
        for k in blocks:
            assert [b[1] for b in sorted(rows, key=lambda b: b[-1]) if b[0] == k] == list(
                range(blocks[k])
            )


def test_equal_weights_do_not_drift(spark):
    # Ten slots to a round: rounded weights of 4, 3 and 3 would put "a" 20 blocks ahead.
    docs = frame(spark, [row(i, "w", "en", "abc"[i % 3]) for i in range(900)])
    options = {"weights": dict.fromkeys("abc", 1), "block_words": 1, "quanta": 10}
    taken = collections.Counter()
    for r in sorted(mixing.mix(docs, **options).collect(), key=lambda r: r.slot):
        taken[r.source] += 1
        assert max(abs(taken[k] - (r.slot + 1) / 3) for k in "abc") < 1


def sources(n=300):
    rng = random.Random(6)
    return [
        row(i, " ".join(["w"] * rng.randint(0, 40)), "en", rng.choice(["big"] * 6 + ["x", "y", None]))
        for i in range(n)
    ]


@pytest.mark.parametrize("window_rows", [20_000, 16])
def test_mixing_places_every_row_once(spark, window_rows):
    rows = sources() + [row(5, "same text", "en", "x")] * 3 + [row(None, None, None, None)]
    docs = clashing(frame(spark, rows))
    options = {"block_words": 50, "quanta": 20, "window_rows": window_rows}
    got = mixing.mix(docs, **options).collect()
    assert len(got) == len(rows)
    words = collections.Counter()
    by_block = collections.defaultdict(set)
    for r in got:
        words[r.source] += r.n_words
        by_block[r.source, r.block].add((r.slot, r.release, r.deadline, r.phase))
        assert r.release <= r.slot < r.deadline
    assert all(len(v) == 1 for v in by_block.values())
    slots = [next(iter(v))[0] for v in by_block.values()]
    assert len(set(slots)) == len(slots)
    for name, total in words.items():
        assert max(b for s, b in by_block if s == name) <= max(0, -(-total // 50) - 1)
    ordered = mixing.mixed(docs, **options)
    assert ordered.columns == docs.columns and ordered.count() == len(rows)
    place = {}
    for r in got:
        place.setdefault((r.doc_id, r.source), r.slot)
    seen = [place[r.doc_id, r.source] for r in ordered.collect()]
    assert seen == sorted(seen)


def test_named_weights_and_the_rest(spark):
    docs = frame(spark, sources())
    got = mixing.schedule(docs, weights={"x": 3, "y": 1}, block_words=20, quanta=10).collect()
    assert {r.lane for r in got} == {"=x", "=y", "rest"}
    assert len(got) == 300
    few = mixing.schedule(docs, block_words=20, most_sources=2).collect()
    assert len({r.lane for r in few}) == 3 and len(few) == 300


@pytest.mark.parametrize("window_rows", [20_000, 30])
def test_sources_beyond_the_largest_keep_to_their_weights(spark, window_rows):
    # Beside two large sources, those of the rest: of 100, 25 and 4 one-word documents.
    sizes = {"big": 400, "large": 225, "a": 100, "b": 25, "c": 4}
    names = [k for k, n in sizes.items() for _ in range(n)]
    docs = frame(spark, [row(i, "w", "en", k) for i, k in enumerate(names)])
    options = {"block_words": 1, "quanta": 10, "window_rows": window_rows, "most_sources": 2}
    got = sorted(mixing.schedule(docs, **options).collect(), key=lambda r: r.slot)
    assert [r.slot for r in got] == list(range(len(names)))
    assert {r.lane for r in got} == {"=big", "=large", "rest"}
    # Square roots: 20, 15, 10, 5 and 2 of 52, until "c" of 4 is used up by turn 2, after 104.
    taken = collections.Counter()
    for r in got[:100]:
        taken[r.source] += 1
        assert all(
            abs(taken[k] - (r.slot + 1) * n**0.5 / 52) < 3 for k, n in sizes.items()
        ), (r.slot, taken)
    order = [r.source for r in got if r.lane == "rest"]
    seen = collections.Counter()
    for k in order[:80]:
        seen[k] += 1
        assert abs(seen["a"] / 10 - seen["b"] / 5) <= 0.3


def test_named_sources_have_lanes_however_many_there_are(spark):
    docs = frame(spark, [row(i, "w " * 5, "en", f"s{i % 9}") for i in range(90)])
    weights = {f"s{i}": i + 1 for i in range(6)}
    got = mixing.schedule(docs, weights=weights, block_words=5, most_sources=2).collect()
    assert {r.lane for r in got} == {f"=s{i}" for i in range(6)} | {"rest"}
    # Three sources not named, of the least weight each: 3 of 24 slots go to the rest.
    assert sum(r.lane == "rest" for r in got if r.slot < 24) == 3
    named = mixing.schedule(docs, weights=weights | {"rest": 21}, block_words=5).collect()
    assert sum(r.lane == "rest" for r in named if r.slot < 24) == 12
    one = mixing.schedule(docs, most_sources=0, block_words=5).collect()
    assert {r.lane for r in one} == {"rest"} and len(one) == 90


def test_mixing_of_an_empty_table(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    assert mixing.mixed(frame(spark, [])).collect() == []


# --- the pipeline ------------------------------------------------------------------------


def words_alike(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def holds_passage(words, item, stretch=13, share=0.8):
    """Some way of laying the item along the text has a stretch with enough equal words."""
    stretch = min(stretch, len(item))
    places = collections.defaultdict(list)
    for j, word in enumerate(item):
        places[word].append(j)
    diagonals = collections.defaultdict(list)
    for i, word in enumerate(words):
        for j in places.get(word, ()):
            diagonals[i - j].append(j)
    enough = -(-stretch * 4 // 5)
    return any(
        b - a < stretch
        for found in diagonals.values()
        for a, b in zip(sorted(found), sorted(found)[enough - 1 :], strict=False)
    )


def test_pipeline_stages_against_brute_force(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_dir(spark, "stages")
    kept = {r.doc_id: r.text for r in docs.collect()}
    bench = [words_alike(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert min(map(len, bench)) >= 13
    for name, stage in pipeline.STAGES:
        result = stage(spark, docs, sf_dir)
        if name != "token_files":
            assert result.columns == docs.columns
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids))
        if name == "language_id":
            kept = {i: t for i, t in kept.items() if t and any(c.isalpha() for c in t)}
        elif name == "simhash_near_dedup":
            prints = {i: brute_fingerprint(t) for i, t in kept.items()}
            root = brute_groups(prints.values(), 2)
            least = {}
            for i in sorted(kept):
                least.setdefault(root[prints[i]], i)
            kept = {i: kept[i] for i in least.values()}
        elif name == "decontamination":
            leaked = {
                i for i, t in kept.items() if any(holds_passage(words_alike(t), b) for b in bench)
            }
            assert leaked
            kept = {i: t for i, t in kept.items() if i not in leaked}
        assert set(ids) == set(kept), name
    rows = docs.orderBy("start").collect()
    assert sum(r.n_tokens for r in rows) == rows[-1].start + rows[-1].n_tokens
    for r in rows[:20]:
        ids = np.array(reference(kept[r.doc_id]) + [1], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids.tobytes())


def test_pipeline_stages_on_odd_rows(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = clashing(frame(spark, ODD))
    kept = {}
    for name, stage in pipeline.STAGES:
        result = stage(spark, docs, sf_dir)
        kept[name] = result.count()
        if name != "token_files":
            assert result.columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).collect() == []
    unknown = sum(not any(c.isalpha() for c in r[1] or "") for r in ODD)
    assert kept == {
        "language_id": len(ODD) - unknown,
        "simhash_near_dedup": len(
            set(brute_groups([brute_fingerprint(r[1]) for r in ODD], 2).values())
        ),
        "decontamination": len(ODD),
        "mixing": len(ODD),
        "token_files": len(ODD),
    }


def test_queries_have_stable_columns():
    from marketbars.llm.queries import ORACLE, QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) < set(QUERIES)


SQL = ["op2_decontamination", "op7_substring_dedup", "op8_line_dedup", "op13_url_filters"]


@pytest.mark.parametrize("name", SQL)
def test_queries_against_sql(spark, sf_dir, name):
    from compare import connect, oracle_rows, spark_rows

    from marketbars.llm.queries import ORACLE, QUERIES

    assert spark_rows(QUERIES[name](spark, sf_dir)) == oracle_rows(connect(sf_dir), ORACLE[name])
