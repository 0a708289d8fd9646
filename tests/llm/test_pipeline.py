import corpus_pipeline as p
from millrace.llm.queries import tokenizer_path
from tests.llm.brute import base_counts, components, jaccard_links, shingles


def test_stages_on_their_own_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    (_, quality), (_, lines), (_, near), (_, mixed), (_, pieces) = p.STAGES

    first = quality(spark, docs, sf)
    assert first.columns == columns
    failed = {r.doc_id for r in docs.collect() if (c := base_counts(r.text))[0] < 50 or 100 * c[4] > 50 * c[0]}
    kept = {r.doc_id for r in first.collect()}
    assert not kept & failed and len(kept) >= 0.95 * (docs.count() - len(failed))

    second = lines(spark, first, sf).cache()
    assert second.columns == columns and {r.doc_id for r in second.collect()} <= kept

    third = near(spark, second, sf)
    assert third.columns == columns
    sets = {r.doc_id: shingles(r.text) for r in second.collect()}
    roots = components(sets, jaccard_links(sets))
    assert {r.doc_id for r in third.collect()} == set(roots.values())

    fourth = mixed(spark, third, sf).cache()
    assert fourth.columns == columns and {r.doc_id for r in fourth.collect()} <= set(roots.values())

    last = pieces(spark, fourth, sf)
    assert last.count() == fourth.count() and "piece_ids" in last.columns
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    for r in last.limit(20).collect():
        assert sp.decode(r.piece_ids) == r.text


def test_odd_rows(spark, odd_docs, no_docs):
    odd = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for k, (_, stage) in enumerate(p.STAGES):
        out = stage(spark, odd, "")
        got = {(r.doc_id, r.text) for r in out.collect()}
        assert got <= {(r.doc_id, r.text) for r in odd.collect()}
        assert stage(spark, no_docs, "").count() == 0
        if k == 0:
            assert not got  # under 50 words, or most of them repeated
        if k == 2:
            # ids 3 and 4 are copies; texts without a word stay, and so do rows without an identifier
            assert sorted(i for i, _ in got if i) == [1, 2, 3, 7, 8, 9] and out.where("doc_id is null").count() == 2


def test_near_copies_of_rows_that_share_an_identifier(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words), (2, words), (2, "a text of its own " * 3), (3, "twice " + words[::-1]), (3, "twice " + words[::-1]), (4, "lone words here")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id, r.text) for r in p.near_copies(spark, docs, "").collect())
    assert got == sorted({rows[0], rows[2], rows[3], rows[5]})
