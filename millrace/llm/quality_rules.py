"""Quality rules: per-document base rules plus cross-document line frequency within a host."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._base import Scratch, maybe_broadcast

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
NO_HOST = "\x00no host"

_SCHEMA = (
    "doc_id long, host string, text_h long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, line_h array<long>, line_words array<long>"
)


def repeated_words(words: list) -> int:
    """Words inside 3-word windows that occur twice or more in the text, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    base = len(ids)
    if base == n:
        return 0
    if base < 2_000_000:  # exact: the code of a window stays below 2**63
        code = (w[:-2] * base + w[1:-1]) * base + w[2:]
    else:
        first = np.unique(w[:-2] * base + w[1:-1], return_inverse=True)[1]
        code = first.astype(np.int64) * base + w[2:]
    order = np.argsort(code, kind="stable")
    run = code[order]
    same = run[1:] == run[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] = twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _h64(b: bytes) -> int:
    return xxhash.xxh64_intdigest(b) - (1 << 63)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, hosts, text_h = batch.column(0), batch.column(1).to_pylist(), batch.column(2), batch.column(3)
        out: list[tuple] = []
        line_h: list[int] = []
        line_w: list[int] = []
        ends = [0]
        for text in texts:
            text = text or ""
            raw = text.encode()
            words = raw.split()
            spaces = sum(map(text.count, SPACE))
            seen: set[bytes] = set()
            filled = 0
            for line in raw.split(b"\n"):
                own = line.split()
                if own:
                    filled += 1
                    seen.add(line)
                    line_h.append(_h64(b" ".join(own).lower()))
                    line_w.append(len(own))
            ends.append(len(line_h))
            symbols = sum(map(text.count, SYMBOLS))
            out.append((len(words), len(text) - spaces, symbols, filled - len(seen), repeated_words(words)))
        cols = [pa.array([r[k] for r in out], pa.int64()) for k in range(5)]
        offsets = pa.array(ends, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (line_h, line_w)]
        names = [f.strip().split(" ")[0] for f in _SCHEMA.split(",")]
        yield pa.RecordBatch.from_arrays([ids, hosts, text_h, *cols, *lists], names=names)


def quality_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_docs: int = 10,
    max_share: float = 0.2,
    min_left: float = 0.2,
    max_docs: int = 100,
) -> DataFrame:
    """One row per input row with its base counts, ``base_failed``, the line-frequency figures and ``kept``.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_frequent_words
    (words in removed lines), words_left, text_h (``text_hash`` of the text).

    Lines are normalised (A-Z lowered, white space collapsed) and hashed. For each host the distinct documents that
    hold a line are counted, exact copies of a text as one document. A line above the limits, in at least ``min_docs``
    documents and more than ``max_share`` of the host's documents, is template text and is removed. A document is
    depleted, and rejected, when less than ``min_left`` of its words are left. In a large host a share is far above what
    template lines reach, so a line in more than ``max_docs`` documents is template text too, if more than ``max_docs``
    of them have text of their own, which means that they are not depleted by all such lines. Groups of near copies,
    whose lines stand in each other only, stay out of that.

    Base rule: fewer than 50 words, or more than half of the words inside repeated 3-word windows, fails.

    Null text is empty (and fails the base rule); null hosts form one host; repeated rows each get a row; other
    columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    host = F.coalesce(F.col(host_col).cast("string"), F.lit(NO_HOST))
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), host.alias("host"), text_hash(text).alias("text_h")
    )
    measured = scratch.save(
        rows.mapInArrow(_measure, _SCHEMA).withColumn("row", F.monotonically_increasing_id()), "measured"
    )
    # one row for each host, line and distinct text: copies of a text count once, and the key spreads any common line
    once = measured.select("host", "text_h", F.explode(F.array_distinct("line_h")).alias("h")).distinct()
    per_line = once.groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs)
    per_host = measured.select("host", "text_h").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    sure = F.col("docs") > max_share * F.col("host_docs")
    found = per_line.join(per_host, "host").where(sure | (F.col("docs") > max_docs))
    found = scratch.save(found.select("host", "h", sure.alias("sure")), "candidates")
    lines = measured.select("row", "host", "text_h", F.explode(F.arrays_zip("line_h", "line_words")).alias("l")).select(
        "row", "host", "text_h", F.col("l.line_h").alias("h"), F.col("l.line_words").alias("w")
    )
    hits = scratch.save(lines.join(maybe_broadcast(found), ["host", "h"]), "hits")
    all_gone = hits.groupBy("row").agg(F.sum("w").alias("gone"))
    full = measured.select("row", "n_words").join(all_gone, "row").where(F.col("n_words") - F.col("gone") >= min_left * F.col("n_words"))
    own = hits.where(~F.col("sure")).join(full.select("row"), "row", "left_semi").select("host", "h", "text_h").distinct()
    own = own.groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > max_docs).select("host", "h")
    frequent = scratch.save(found.where("sure").select("host", "h").unionByName(own), "frequent")
    removed = hits.join(maybe_broadcast(frequent), ["host", "h"], "left_semi").groupBy("row").agg(F.sum("w").alias("n_frequent_words"))
    gone = F.coalesce(F.col("n_frequent_words"), F.lit(0).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - gone
    return measured.join(removed, "row", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (left >= min_left * F.col("n_words"))).alias("kept"),
        gone.alias("n_frequent_words"),
        left.alias("words_left"),
        "text_h",
    )
