import numpy as np

from millrace.llm.queries import op3_shard_hypergeometric
from millrace.llm.sharding import communication_matrix, hypergeometric, shard


def check(rows, n_shards, total):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(n_shards)]
    assert sum(sizes) == total and max(sizes) - min(sizes) <= 1
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))


def test_query(spark, sf01):
    rows = op3_shard_hypergeometric(spark, sf01).collect()
    check(rows, 40, 1000)
    assert len({r.doc_id for r in rows}) == 1000
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_many_partitions_and_ranges(spark, monkeypatch):
    from millrace.llm import sharding

    monkeypatch.setattr(sharding, "ROWS_A_TASK", 100)
    df = spark.range(5003).selectExpr("id as doc_id", "cast(id as string) as text")
    rows = shard(df, 7, partitions=13).collect()
    check(rows, 7, 5003)
    again = {(r.doc_id, r.shard, r.slot) for r in shard(df.repartition(5), 7, partitions=13).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_repeated_rows_keep_sizes_exact(spark):
    rows = [(1, f"t{i}") for i in range(100)] + [(2, "same")] * 57 + [(None, None)] * 31 + [(i, "u") for i in range(3, 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = shard(df, 9, partitions=4).collect()
    check(out, 9, len(rows))
    assert sorted((r.doc_id, r.text) for r in out if r.doc_id is not None) == sorted(r for r in rows if r[0] is not None)


def test_hot_identifier_is_dealt_by_content(spark):
    """A third of all rows under one identifier, half of them equal: sizes stay exact, no row is lost, and the rows of
    different content are dealt the same way in any arrangement of the input."""
    rows = [(5, f"t{i}") for i in range(1000)] + [(5, "same")] * 1000 + [(10 + i, "u") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = shard(df.repartition(7), 6).collect()
    check(out, 6, len(rows))
    assert sorted((r.doc_id, r.text) for r in out) == sorted(rows)
    again = shard(df.repartition(3), 6).collect()
    assert sorted(tuple(r) for r in out if r.text != "same") == sorted(tuple(r) for r in again if r.text != "same")


def test_odd_rows(odd_docs):
    out = shard(odd_docs, 4)
    check(out.collect(), 4, 10)
    assert out.columns == [c for c in odd_docs.columns if c not in ("shard", "slot", "_vp")] + ["shard", "slot"]


def test_empty(no_docs):
    assert shard(no_docs, 4).count() == 0


def test_matrix_margins_and_uniformity():
    a = communication_matrix([30, 0, 70], [25, 25, 50], 1)
    assert a.sum(1).tolist() == [30, 0, 70] and a.sum(0).tolist() == [25, 25, 50]
    draws = np.array([communication_matrix([10, 10], [10, 10], s)[0, 0] for s in range(2000)])
    assert abs(draws.mean() - 5) < 0.12 and abs(draws.var() - 20 / 4 * 5 / 19) < 0.2


def test_large_totals():
    rng = np.random.default_rng(0)
    draws = [hypergeometric(rng, 4 * 10**9, 6 * 10**9, 10_000) for _ in range(400)]
    assert abs(np.mean(draws) - 4000) < 12 and abs(np.std(draws) - 49) < 8
