import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import awkward, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as pb

from tidemark.llm import pieces as P

FILE = public_tokenizers.path(P.MODEL)
HARD = ["", " ", "  a  b   c\n\n你好 ñandú 𝔘𝔫 <s> </s> <0x0A> hello.World\tx", "a" * 300, "éééé  ​ zwj", "internationalization of counter-revolutionaries", " " * 37 + "x", " lead", "trail  ", "x" * 40_000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


def ids(model, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in model.encode(texts)]


def test_ids_are_the_librarys_and_come_back(library):
    texts = HARD + [t for _, t in awkward(9) if t]
    m = P.model(FILE)
    assert ids(m, texts) == [library.encode(t) for t in texts]
    assert [m.decode(x) for x in m.encode(texts)] == texts


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("the rangeTHE .,'\n-éß你😀12")), max_size=25), max_size=4))
def test_any_text(texts):
    m = P.model(FILE)
    lib = sentencepiece.SentencePieceProcessor(model_file=FILE)
    assert ids(m, texts) == [lib.encode(t) for t in texts]
    assert [m.decode(x) for x in m.encode(texts)] == texts


def unigram():
    m = pb.ModelProto()
    with open(FILE, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = m.trainer_spec.UNIGRAM
    r = np.random.default_rng(2)
    for p in m.pieces:
        if p.type == p.NORMAL:
            p.score = -float(r.uniform(3, 15)) / (1 + 0.2 * len(p.piece))
    return m.SerializeToString()


def test_unigram_models_against_all_segmentations():
    m = P.Model(unigram())
    for word in ["▁theres", "▁in", "▁andre", "▁x你y", "▁▁▁to"]:
        best = {0: (0.0, [])}
        for end in range(1, len(word) + 1):  # plain dynamic programme for one word
            options = [(best[a][0] + m.scores[m.ids[word[a:end]]], [*best[a][1], word[a:end]]) for a in range(end) if word[a:end] in m.ids]
            if word[end - 1] not in m.ids:
                options.append((best[end - 1][0] + m.lost, [*best[end - 1][1], word[end - 1]]))
            best[end] = max(options)
        assert list(m.walk([word])) == [(word, best[len(word)][1])]
    words = sorted({"▁" + "the rain in there then".replace(" ", "")[i:j] for i in range(18) for j in range(i + 1, 19)})
    assert list(m.walk(words)) == [next(m.walk([w])) for w in words]  # shared prefixes change nothing


def test_unigram_models_against_the_library():
    proto = unigram()
    lib = sentencepiece.SentencePieceProcessor(model_proto=proto)
    texts = [t for _, t in awkward(10) if t] + ["The rain in Spain, there."]
    assert ids(P.Model(proto), texts) == [lib.encode(t) for t in texts]


def test_table(spark, library):
    rows = awkward(7)
    out = P.decode(P.encode(frame(spark, rows))).collect()
    assert sorted(((r.doc_id, r.decoded, r.n_ids) for r in out), key=repr) == sorted(((i, t or "", len(library.encode(t or ""))) for i, t in rows), key=repr)
    both = P.round_trip(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.decoded, r.n_ids, r.ids_crc32) for r in both), key=repr) == sorted(((r.doc_id, r.decoded, r.n_ids, r.ids_crc32) for r in out), key=repr)
    assert P.encode(frame(spark, [])).collect() == []
