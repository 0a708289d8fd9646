import random

import pytest
import sentencepiece

from millrace.llm import sentencepiece_nbest as m
from millrace.llm.queries import op2_sentencepiece_nbest, tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    """The lattice search alone: its best segmentation leads."""
    model = m.PieceModel(PATH)
    assert model.merges
    model.merges = False
    return model


def test_first_is_the_librarys(spark, sf):
    """The file is one of merges: ids are those of the library for every text, and it leads the N best."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += ["a  b   c\n\nx", "▁▁x", "", "   ", "日本語 text é", "x" * 3_000, "\t\ta\n b", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for r in m.encode(df, PATH, n_best=3, full=True, check=True).collect():
        assert r.piece_ids == sp.encode(r.text or "") == r.nbest_ids[0] and r.n_pieces == len(r.piece_ids)
        assert r.nbest_scores == sorted(r.nbest_scores, reverse=True) and r.round_trip
        assert len({tuple(x) for x in r.nbest_ids}) == len(r.nbest_ids)


def test_long_unbroken_text(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(300_000))
    r = m.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH, check=True).first()
    assert r.round_trip and len(r.nbest_scores) == 4


def every_path(model, s):
    into = [model.into(s, j) if j else [] for j in range(len(s) + 1)]
    ways = {0: [(0.0, ())]}
    for j in range(1, len(s) + 1):
        ways[j] = [(w0 + w, ids0 + ids) for i, ids, w in into[j] for w0, ids0 in ways[i]]
    return ways[len(s)]


@pytest.mark.parametrize("s", ["▁hello", "ation", "▁▁▁a", "xyzé", "▁日本一x", "\n", "thereou", "éà"])
def test_nbest_equals_enumeration(model, s):
    want = sorted((-w for w, _ in every_path(model, s)))[:6]
    got = model.nbest(s, 6)
    assert [-w for w, _ in got] == pytest.approx(want, abs=1e-3)
    assert len({ids for _, ids in got}) == len(got)
    assert {ids for _, ids in got} <= {ids for _, ids in every_path(model, s)}


def test_vector_form_equals_search(model):
    rng = random.Random(3)
    words = list({"".join(rng.choice("▁abcdeéñthion.,!日") for _ in range(rng.randrange(1, 20))) for _ in range(400)})
    model.learn(set(words))
    for w in words:
        ids, score, gap = model.best(w)
        two = model.nbest(w, 2)
        assert score == pytest.approx(two[0][0], abs=1e-3)
        assert gap == pytest.approx(two[0][0] - two[1][0], abs=1e-3) if len(two) > 1 else gap == float("inf")
        assert ids in {p for w_, p in every_path(model, w) if abs(w_ - score) < 1e-3} if len(w) < 12 else True


def test_text_nbest_equals_whole_lattice(model):
    rng = random.Random(4)
    for _ in range(60):
        text = " ".join("".join(rng.choice("abeéthion.\n") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 4)))
        norm = model.normalize(text)
        segments = model.segments(norm)
        assert "".join(segments) == norm
        model.learn(set(segments))
        got = model.encode(segments, 4)
        want = model.nbest(norm, 4)  # the same search without segments
        assert [w for w, _ in got] == pytest.approx([w for w, _ in want], abs=1e-2)
        assert len({tuple(i.tolist()) for _, i in got}) == len(got)
        for _, ids in got:
            assert model.decode(ids.tolist()) == text


def test_normalize_and_decode_equal_library(model):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ("a  b", " lead", "tail ", "é　x\n", "日本 \U0001f600", "▁"):
        ids = sp.encode(text)
        assert model.decode(ids) == sp.decode(ids)
    assert sp.normalize("x") == model.normalize("x")


def test_query_round_trip(spark, sf):
    rows = op2_sentencepiece_nbest(spark, sf).collect()
    assert len(rows) == 200 and all(r.round_trip for r in rows)
    assert all(r.nbest_scores == sorted(r.nbest_scores, reverse=True) and r.n_pieces == len(r.piece_ids) for r in rows)
    assert all(len(r.nbest_crc) == len(set(r.nbest_crc)) == 4 for r in rows if r.n_pieces > 9)


def test_odd_rows(odd_docs):
    out = m.decode(m.encode(odd_docs, PATH, full=True), PATH).collect()
    for r in out:
        assert r.decoded_text == (r.text or "") and r.nbest_ids[0] == r.piece_ids
    assert {(r.n_pieces, tuple(r.nbest_scores)) for r in out if not r.text} == {(0, (0.0,))}


def test_empty(no_docs):
    assert m.encode(no_docs, PATH).count() == 0
