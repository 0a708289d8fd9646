import math
from collections import Counter

from millrace.llm.mixing import mix, source_rates
from millrace.llm.queries import op1_mix_poisson


def test_weights_are_met(spark):
    df = spark.range(40_000).selectExpr("id as doc_id", "case when id % 10 < 7 then 'big' when id % 10 < 9 then 'mid' end as source")
    out = mix(df, weights={"big": 0.25, "mid": 0.5, "": 0.25}).groupBy("source").count().collect()
    got = {r.source: r["count"] for r in out}
    for source, share in (("big", 0.25), ("mid", 0.5), (None, 0.25)):
        assert abs(got[source] - 40_000 * share) < 5 * math.sqrt(40_000 * share)


def test_counts_are_poisson(spark):
    df = spark.range(20_000).selectExpr("id as doc_id", "'s' as source")
    counts = Counter(r["count"] for r in mix(df, budget=40.0).groupBy("doc_id").count().collect())
    mean = sum(k * v for k, v in counts.items()) / 20_000
    var = sum(k * k * v for k, v in counts.items()) / 20_000 - mean**2
    assert abs(mean - 40) < 0.2 and abs(var - 40) < 2  # above MEAN_STEP: a sum of steps
    small = mix(df, budget=0.5).groupBy("doc_id").count().count()
    assert abs(small / 20_000 - (1 - math.exp(-0.5))) < 0.015


def test_order_is_global(spark, sf):
    rows = op1_mix_poisson(spark, sf).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    copies = Counter(r.doc_id for r in rows)
    for i, n in copies.items():
        assert sorted(r.copy for r in rows if r.doc_id == i) == list(range(n))


def test_odd_rows(odd_docs):
    out = mix(odd_docs, budget=3.0)
    assert out.columns == [c for c in odd_docs.columns if c not in ("copy", "position")] + ["copy", "position"]
    assert out.count() > 5
    assert mix(odd_docs, weights={"nowhere": 1.0}).count() == 0


def test_empty(no_docs):
    assert mix(no_docs).count() == 0 and source_rates(no_docs).count() == 0
