from millrace.llm.quality_rules import quality_rules, repeated_words
from millrace.llm.queries import op5_quality_line_rules
from tests.llm.brute import base_counts


def check_base(rows, got):
    texts = {}
    for r in rows:
        texts.setdefault(r.doc_id, r.text)
    for r in got:
        want = base_counts(texts[r.doc_id]) if r.doc_id is not None else None
        if want:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r.base_failed and r.kept)


def test_query(spark, sf01):
    rows = spark.read.parquet(f"{sf01}/documents.parquet").collect()
    got = op5_quality_line_rules(spark, sf01).collect()
    assert len(got) == len(rows)
    check_base(rows, got)


def test_odd_rows(odd_docs):
    got = quality_rules(odd_docs).collect()
    assert len(got) == odd_docs.count()
    check_base(odd_docs.select("doc_id", "text").collect(), got)


def test_empty(no_docs):
    assert quality_rules(no_docs).count() == 0


def test_windows():
    assert repeated_words("a b c x a b c".split()) == 6
    assert repeated_words("a a a a".split()) == 4
    assert repeated_words("a a a".split()) == 0


def test_template_lines_deplete(spark):
    menu = "\n".join(" ".join(f"m{i}e{j}" for j in range(7)) for i in range(10))
    body = lambda i: " ".join(f"own{i}w{j}" for j in range(60))
    rows = [(i, menu + "\n" + f"tail{i}", "h1") for i in range(12)] + [(100 + i, body(i), "h1") for i in range(12)]
    rows += [(200 + i, menu + f"\nother{i}", "h2") for i in range(5)]  # below min_docs: stays
    rows += [(300 + i, "\n".join(["copied line with seven words in it"] + [body(999)]), "h3") for i in range(40)]
    rows += [(400 + i, body(1000 + i), "h3") for i in range(9)]  # copies of one text are one document
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(not got[i].kept and not got[i].base_failed and got[i].n_frequent_words == 70 for i in range(12))
    assert all(got[100 + i].kept for i in range(12))
    assert all(got[200 + i].kept for i in range(5))
    assert all(got[300 + i].kept and got[300 + i].n_frequent_words == 0 for i in range(40))


def test_template_lines_of_a_large_host(spark):
    """Template lines in far less than a fifth of a large host; near copies of one text are not template text."""
    line = lambda k: " ".join(f"t{k}x{j}" for j in range(15))
    body = lambda i: " ".join(f"own{i}w{j}" for j in range(400))
    menu = "\n".join(line(k) for k in range(5))
    copy = "\n".join(line(100 + k) for k in range(6))
    rows = [(i, menu + "\n" + body(i)) for i in range(110)] + [(1000 + i, body(1000 + i)) for i in range(900)]
    rows += [(5000, menu), (5001, menu + "\nlast")] + [(6000 + i, copy + f"\nend{i}") for i in range(120)]
    df = spark.createDataFrame([(*r, "h") for r in rows], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality_rules(df).collect()}
    assert {i for i, r in got.items() if not r.kept} == {5000, 5001} and not got[5000].base_failed
    assert all(r.n_frequent_words == (75 if i < 110 or 5000 <= i < 6000 else 0) for i, r in got.items())
