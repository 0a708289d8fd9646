import random

import pytest

from millrace.llm import token_counts as m
from millrace.llm.queries import op6_token_counts_resync, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_query_equals_library(spark, sf01, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf01}/documents.parquet").collect()}
    want = dict(zip(texts, (len(e) for e in library.encode_batch(list(texts.values()), add_special_tokens=False)), strict=True))
    for r in op6_token_counts_resync(spark, sf01).collect():
        assert r.n_tokens == want[r.doc_id] and r.over_limit == (r.n_tokens > 2048)
        assert r.n_bytes == len(texts[r.doc_id].encode())


def test_resync_equals_library(library):
    rng = random.Random(5)
    bits = ["don't", "I'll've", "<|endoftext|>", "ß", "é", "́x", "naïve", "12345", "!!??", "　", "\x85", "\x1c", "Σας", "a b", "x" * 90, "İ"]
    for chunk, overlap in ((60, 8), (200, 20), (1000, 100)):
        for _ in range(30):
            text = "".join(rng.choice(bits) + rng.choice(["", " ", "  ", "\n", "\t "]) for _ in range(rng.randrange(300)))
            encoder = m.Encoder(PATH)
            assert m.count_resync(text, encoder, chunk, overlap)[0] == len(library.encode(text, add_special_tokens=False))
            assert encoder.count([text])[0] == len(library.encode(text, add_special_tokens=False))


def test_no_space_widens_to_the_whole_text(library):
    text = "ab" * 3000
    n, widened = m.count_resync(text, m.Encoder(PATH), 500, 20)
    assert n == len(library.encode(text, add_special_tokens=False)) and widened > 0


def test_odd_rows(odd_docs, library):
    got = m.count_tokens(odd_docs, PATH, chunk=5000, overlap=50).collect()
    texts = [t.text or "" for t in odd_docs.select("text").collect()]
    assert sorted(r.n_tokens for r in got) == sorted(len(library.encode(t, add_special_tokens=False)) for t in texts)


def test_empty(no_docs):
    assert m.count_tokens(no_docs, PATH).count() == 0


def test_other_kinds(spark, sf):
    import sentencepiece

    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20)
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in m.count_tokens(docs, tokenizer_path("piece_bpe_32k.model")).collect():
        assert r.n_tokens == len(sp.encode(texts[r.doc_id]))
