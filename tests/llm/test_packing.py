import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import awkward, frame
from tokenizers import Tokenizer

from tidemark.llm import packing as P

FILE = public_tokenizers.path(P.TOKENIZER)
HARD = ["élan, Été. ÿß Ÿ × µ ÷, ª naïve,. . , Über Straße ÀÖØÞ", "ÀÉ ñ combining é H̱ x", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "Don't we'LL it's 'S x's.", "one,two.three a.b, A1B2 3.14 !!!", "日本 語。 ​ non break", "ΑΣ ΣΑΣ İı ß", "\t\n", "The,the. THE"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def test_word_ids_are_the_tokenizers_ids(tokenizer):
    ids = P.WordIds(FILE)
    for text in HARD + [t for _, t in awkward(8) if t]:
        got = np.frombuffer(b"".join(map(ids.__getitem__, text.encode().split())), "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("size", [P.SIZE, 64])
def test_pieces_and_places(spark, tokenizer, size):
    rows = awkward(6) + [(500 + i, t) for i, t in enumerate(HARD)] + [(600, "word " * 5000)]
    out = P.pack(frame(spark, rows), size=size, with_ids=True).collect()
    pieces = sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr)
    want = []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(i, n, at, len(ids[at : at + size]), zlib.crc32(ids[at : at + size].tobytes())) for n, at in enumerate(range(0, len(ids), size))]
    assert pieces == sorted(want, key=repr)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in out)
    bins: dict = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    total = sum(r.length for r in out)
    assert len(bins) <= -(-total // size) * 1.05 + 1


def test_empty_table(spark):
    assert P.pack(frame(spark, [])).collect() == []


def test_sums_of_squares_choice():
    # bins with gaps 6, 6 and 4 stand open; 4 fits exactly in the last one, but leaving one gap of 6 counts less
    at, offset, gaps = P.place(np.array([6, 4, 4, 4]), 10)
    assert offset.tolist() == [0, 6, 0, 4] and gaps.tolist() == [0, 2]
    r = np.random.default_rng(1)
    sizes = r.integers(1, 2049, 3000)
    at, offset, gaps = P.place(sizes, 2048)
    used = np.bincount(at, sizes)
    assert (used + gaps == 2048).all() and len(gaps) <= 1.02 * max(sizes.sum() / 2048, (sizes > 1024).sum())


def test_groups_and_second_placing(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP", 50)
    rows = [(i, "a " * (7 * i % 600)) for i in range(400)]
    out = P.pack(frame(spark, rows)).collect()
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out) == 400
    assert len({r.sequence_id for r in out}) <= -(-sum(r.length for r in out) // 2048) + 4
