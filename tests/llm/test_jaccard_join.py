import random

import pytest

from millrace.llm import jaccard_join as m
from millrace.llm.queries import op4_ngram_jaccard_join
from tests.llm.brute import components, jaccard_links, shingles


def expected(rows, k=5):
    sets = {i: shingles(t, k) for i, t in rows}
    comp = components(sets, jaccard_links(sets))
    return sorted((i, len(sets[i]), comp[i]) for i in sets)


def test_query_equals_brute_force(spark, sf01):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in op4_ngram_jaccard_join(spark, sf01).collect())
    assert got == expected(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_group_and_shared_passage(spark, seed, monkeypatch):
    """Near copies at all distances around the threshold, and one passage inside many unlike documents."""
    monkeypatch.setattr(m, "SAMPLE", 64)
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(4000))
    base = [word() for _ in range(90)]
    passage = [word() for _ in range(30)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join([word() for _ in range(40)] + passage + [word() for _ in range(rng.randrange(60))])) for i in range(120)]
    rows += [(2000 + i, " ".join(base[: rng.randrange(60, 90)])) for i in range(40)]
    rows += [(3000 + i, rows[i][1].upper()) for i in range(0, 60, 3)]
    rows += [(4000, "one two"), (4001, "ONE  two"), (4002, "one two three"), (4003, ""), (4004, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in m.jaccard_components(df).collect())
    assert got == expected(rows)


def test_odd_rows(odd_docs):
    got = m.jaccard_components(odd_docs).collect()
    by = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert len(got) == 10
    assert by[(1, 0)] == 1 and by[(2, 0)] == 2 and by[(3, 1)] == 3 and by[(4, 1)] == 3 and by[(None, 1)] is None
    assert by[(9, 1)] == 9


def test_empty(no_docs):
    assert m.jaccard_components(no_docs).count() == 0
