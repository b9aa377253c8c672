"""Token alignment against whole texts and plain loops."""

import collections
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from frames import LONG, ODD, PROSE, clashing, frame, row
from tokenizers import Tokenizer

from marketbars.llm import alignment, queries

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = "".join(map(chr, [*range(1, 0x250), 0x2581, 0x3000, 0x2028, 0x1F600, 0x6F22, 0x0301]))
TEXTS = [
    " x", "x ", "  ", " ", "\n", "\n\n x\n", "a\n  b\t\tc   d　e", "a  b   c    ",
    "<|endoftext|> a<s>b</s><unk><0x41>", "▁", "a ▁b", "\0\0 a\0", "﻿x", SIGNS,
    "don't WE'LL 'tis ''s", "x\x1c \x1dy", "a" * 3000, "ab" * 500 + " " + "é" * 500, "x" + " " * 99,
    "１２ ½ ﬁ Å é ́x", " \n \n ", "日本語のテキスト。次の文", "🙂🙂 👩‍👩‍👧 x", "\r\n a\r\n\r\nb",
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    octets = alignment.ByteLevel(A).octets

    def piece(i):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            return bytes([int(name[1:-1], 16)])
        return name.replace("▁", " ").encode()

    def encode(text):
        a = tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids
        b = model.encode(text or "")
        whole = (" " + (text or "")).encode()
        sides = [(i, octets[i]) for i in a], [(i, piece(i)) for i in b]
        if not text or any(b"".join(o for _, o in side) != whole for side in sides):
            return [], []
        return sides

    return encode


def brute(plain, rows):
    """Per row what the operator returns, by a walk along the bytes."""
    found, links = [], []
    for doc_id, text, *_ in rows:
        owner = [[i for i, (_, o) in enumerate(side) for _ in o] for side in plain(text)]
        sides = plain(text)
        cuts = [{0} | set(np.cumsum([len(o) for _, o in side]).tolist()) for side in sides]
        both = sorted(cuts[0] & cuts[1])
        groups = [
            "|".join(
                ",".join(str(side[i][0]) for i in sorted(set(own[x:y])))
                for side, own in zip(sides, owner, strict=True)
            )
            for x, y in zip(both, both[1:], strict=False)
        ]
        pairs = sorted(set(zip(*owner, strict=True)))
        links.append([(sides[0][i][0], sides[1][j][0]) for i, j in pairs])
        found.append((doc_id, len(sides[0]), len(sides[1]), len(groups), len(pairs), groups))
    count = collections.Counter(p for of in links for p in of)
    highest = collections.Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    return collections.Counter(
        (*f[:-1], sum(count[p] == highest[p[1]] for p in of), sum(map(count.get, of)), ";".join(g))
        for (*f, g), of in zip([(*f, f[-1]) for f in found], links, strict=True)
    )


def got(result):
    return collections.Counter(tuple(r) for r in result.collect())


def test_stretches_have_the_ids_of_whole_texts(plain):
    pair = alignment.Pair(A, B, memory=10)
    assert pair.cuts
    rng = random.Random(5)
    mixed = ["".join(rng.choices(SIGNS[:400] + "  \n\n  abc", k=60)) for _ in range(300)]
    for text in [*TEXTS, *mixed, PROSE, LONG[:5000], None]:
        ids = pair.encode([text])[0]
        whole = [[i for i, _ in side] for side in plain(text)]
        for side in (0, 1):
            assert np.frombuffer(b"".join(p[side] for p in ids), "<i4").tolist() == whole[side]


def test_groups_of_overlapping_and_lone_intervals():
    start, end = np.array([0, 4, 9, 0, 2, 6, 9]), np.array([4, 6, 12, 2, 6, 9, 12])
    side = np.array([0, 0, 0, 1, 1, 1, 1])
    assert alignment.coalesced(start, end, side).tolist() == [0, 0, 2, 0, 0, 1, 2]
    left, right = alignment.overlapping(start[:3], end[:3], start[3:], end[3:])
    assert list(zip(left.tolist(), right.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 1), (2, 3)]


@pytest.mark.parametrize("lap", [3, alignment.LAP])
def test_odd_rows_against_brute_force(spark, plain, lap):
    rows = ODD + [row(100 + i, text) for i, text in enumerate(TEXTS)]
    result = alignment.align(clashing(frame(spark, rows)), A, B, lap=lap)
    assert got(result) == brute(plain, rows)


def test_a_text_without_shared_boundaries_is_one_group(spark, plain):
    rows = [row(1, "a" * 4001), row(2, "=" * 3001 + "-" * 777)]
    assert got(alignment.align(frame(spark, rows), A, B)) == brute(plain, rows)


def test_tokenizers_that_cannot_be_cut_get_whole_texts(spark, plain, monkeypatch):
    pair = alignment.Pair(A, B)
    pair.cuts = False
    for text in TEXTS:
        whole = [[i for i, _ in side] for side in plain(text)]
        found = pair.encode([text])[0]
        for side in (0, 1):
            assert np.frombuffer(b"".join(p[side] for p in found), "<i4").tolist() == whole[side]


def test_an_empty_table(spark):
    assert alignment.align(frame(spark, []), A, B).collect() == []
    nothing = [row(1, None), row(2, "")]
    assert got(alignment.align(frame(spark, nothing), A, B)) == collections.Counter(
        [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    )


def test_query_on_the_test_table(spark, sf_dir, plain):
    import hashlib

    docs = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect()]
    want = collections.Counter()
    for (*rest, groups), n in brute(plain, docs).items():
        want[*rest, hashlib.sha256(groups.encode()).hexdigest() if groups else ""] += n
    assert got(queries.QUERIES["op12_token_alignment"](spark, sf_dir)) == want
