import hashlib

import pytest

from millrace.llm import exact_dedup as m
from millrace.llm.queries import op10_exact_dedup_sort
from tests.llm.brute import lower


def expected(rows, best):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = best(known) if known else None
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("keep", "best"), [("smallest", min), ("largest", max)])
def test_odd_rows(odd_docs, keep, best):
    got = sorted((tuple(r) for r in m.exact_dedup(odd_docs, keep=keep).collect()), key=repr)
    assert got == expected([(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()], best)


def test_hot_group_takes_the_other_way(spark):
    rows = [(i, "COPY" if i % 3 == 0 else f"Text {i}") for i in range(3000)] + [(2997, "copy")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((tuple(r) for r in m.exact_dedup(df, keep="largest").collect()), key=repr)
    assert got == expected(rows, max)


def test_empty(no_docs):
    assert m.exact_dedup(no_docs).count() == 0


def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in op10_exact_dedup_sort(spark, sf).collect()), key=repr)
    assert got == expected([tuple(r) for r in rows], max)


def test_native(spark, sf, capsys):
    op10_exact_dedup_sort(spark, sf).explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian"))
    assert plan.count("Exchange rangepartitioning") == 1
