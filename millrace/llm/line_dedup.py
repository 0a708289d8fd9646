"""Fuzzy line dedup by MinHash. The main path is DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._base import Scratch, maybe_broadcast, replacing
from millrace.llm._linking import link_groups

SHINGLE = 5  # characters of a shingle
#: Bands of a line: on the ring of its sorted shingle hashes, the ``ROWS`` distinct ones on either side of ``BANDS / 2``
#: fixed places. Two lines agree in a band when all of those are common, as in a MinHash of so many rows.
BANDS, ROWS = 14, 6
#: Lines with at most so many shingles take a band of ``SHORT_ROWS`` hashes at each place as well: their windows overlap,
#: so long ones alone would find fewer pairs. Two lines that both are this short share both kinds, any others the first.
SHORT, SHORT_ROWS = 48, 4
#: Lines of at least ``WORDY[0]`` words take ``WORD_BANDS`` bands of ``WORD_ROWS`` word marks, and no others from
#: ``WORDY[1]`` words on: long lines of one language have many 5-character shingles in common, but few word marks.
WORDY = (12, 16)
WORD_BANDS, WORD_ROWS, NEXT = 14, 3, 3
#: The sketch of a line: of its ``SKETCH`` smallest hashes 32 bits each. At a similarity of 0.8 two lines have fewer than
#: ``AGREE`` of them in common in one of a thousand cases.
SKETCH, AGREE = 64, 41


def _untidy(text: Column) -> Column:
    """Whether a text has white space other than single spaces and line ends."""
    out = F.contains(text, F.lit("  "))
    for c in "\t\r\x0b\x0c":
        out = out | F.contains(text, F.lit(c))
    return out


def _tidy(low: Column) -> Column:
    return F.when(_untidy(low), F.trim(F.regexp_replace(low, r"\s+", " "))).otherwise(F.trim(low))


def normal(line: Column) -> Column:
    """Lower case, white space collapsed. Only lines that have white space other than single spaces meet the pattern."""
    return _tidy(F.lower(line))


def normal_lines(low: Column, untidy: Column) -> Column:
    """The lines of a lower-case text, white space collapsed. ``untidy``: ``_untidy`` of the whole text; lines of any other
    are trimmed only, and of such a text only those that are untidy themselves meet the pattern."""
    lines = F.split(low, "\n", -1)
    return F.when(untidy, F.transform(lines, lambda x: _tidy(x))).otherwise(F.transform(lines, lambda x: F.trim(x)))


def lowered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, row_h, low, untidy`` of each text: lower-cased and looked through once, not line by line."""
    text = F.col(text_col)
    low = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("row_h"), F.lower(text).alias("low"))
    return low.withColumn("untidy", _untidy(F.col("low")))


def shingles(norm: Column) -> Column:
    """A 64-bit hash of each run of 5 UTF-16 characters, repeats included; a line with fewer is one run. All characters
    have the same width there, so a run is found without a walk through the text."""
    width = 2 * SHINGLE

    def runs(raw: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(raw) - (width - 1), F.lit(1)), F.lit(2))
        return F.transform(starts, lambda i: F.xxhash64(F.substring(raw, i, F.lit(width))))

    return F.get(F.transform(F.array(F.encode(norm, "UTF-16BE")), runs), F.lit(0))


def word_marks(words: Column) -> Column:
    """A 64-bit hash of each of a line's words with the first ``NEXT`` characters of the word after it, repeats included."""

    def marks(words: Column) -> Column:
        return F.transform(words, lambda x, i: F.xxhash64(x, F.substring(F.get(words, i + 1), 1, NEXT)))

    return F.get(F.transform(F.array(words), marks), F.lit(0))


def _ring_keys(df: DataFrame, ring: str, bands: int, kinds: list[tuple[int, int | None]], out: str) -> DataFrame:
    """``df`` with ``out``, the hashes of the line's bands, in place of ``ring``, its sorted distinct hashes, or null: for each
    of ``kinds``, the ``rows`` hashes after each of ``bands / 2`` fixed places and those before it, of rings with at
    most so many hashes. Places are sorted in among the hashes, so finding one is a native search."""
    half = -(-bands // 2)
    places = [-(1 << 63) + k * (1 << 64) // half for k in range(half)]
    names = [c for c in df.columns if c != ring]
    reach = kinds[0][0]
    tail = F.slice(ring, F.greatest(F.size(ring) - (reach - 1), F.lit(1)), reach)
    df = df.select(
        *names,
        F.size(ring).alias("_size"),
        F.concat(tail, ring, F.slice(ring, 1, reach)).alias("_wide"),
        F.sort_array(F.concat(ring, F.array(*[F.lit(p) for p in places]))).alias("_all"),
    )
    # of what comes before a place, k are places
    at = F.array(*[F.array_position("_all", F.lit(p)).cast("int") - k for k, p in enumerate(places)])
    df = df.select(*names, "_size", "_wide", F.when(F.col("_wide").isNotNull(), at).alias("_at"))

    def keys(n: int) -> Column:
        """Lambdas, as one method for all bands unrolled is more than the JVM compiles. Numbers are got one by one: a slice
        would make objects of the whole ring for each band."""

        def band(mark: int, start: Column) -> Column:
            return F.xxhash64(F.lit(mark), *[F.get("_wide", start + k) for k in range(n)])

        def after(i: Column) -> Column:
            return band(n, i + (F.least("_size", F.lit(reach)) - 1))

        def before(i: Column) -> Column:
            return band(-n, F.greatest(i + (F.least("_size", F.lit(reach)) - n - 1), F.lit(0)))

        return F.concat(F.transform("_at", after), F.transform("_at", before))

    found = keys(kinds[0][0])
    for n, most in kinds[1:]:
        found = F.when(F.col("_size") <= most, F.concat(found, keys(n))).otherwise(found)
    return df.select(*names, F.coalesce(found, F.array().cast("array<bigint>")).alias(out))


def with_band_keys(df: DataFrame, bands: int, rows: int) -> DataFrame:
    """``df(norm, ...)`` with ``keys``, the distinct hashes of the line's bands, in place of ``norm``. Lines of fewer than
    ``WORDY[1]`` words take bands of 5-character shingles, lines of ``WORDY[0]`` and more bands of word marks: two
    similar lines have like numbers of words, so they share one kind at least."""
    names = [c for c in df.columns if c != "norm"]
    df = df.select(*names, "norm", F.split("norm", " ", -1).alias("_words"))
    size = F.size("_words")
    df = df.select(
        *names,
        F.when(size < WORDY[1], F.array_distinct(F.sort_array(shingles(F.col("norm"))))).alias("_ring"),
        F.when(size >= WORDY[0], F.array_distinct(F.sort_array(word_marks(F.col("_words"))))).alias("_marks"),
    )
    df = _ring_keys(df, "_ring", bands, [(rows, None), (SHORT_ROWS, SHORT)], "_short")
    df = _ring_keys(df, "_marks", WORD_BANDS, [(WORD_ROWS, None)], "_long")
    return df.select(*names, F.array_distinct(F.concat("_short", "_long")).alias("keys"))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, row_h, line_no, norm, id`` of every line with a character other than white space. ``row_h`` tells rows that
    share an identifier apart; ``id`` is a hash of the normalised line."""
    base = lowered(docs, id_col, text_col)
    lines = base.select("doc", "row_h", F.posexplode(normal_lines(F.col("low"), F.col("untidy"))).alias("line_no", "norm")).where("norm != ''")
    return lines.select("doc", "row_h", "line_no", "norm", F.xxhash64("norm", F.char_length("norm")).alias("id"))


def _texts(docs: DataFrame, places: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """``id, norm`` of the lines at ``places(id, doc, row_h, line_no)``, found by document: only those that have such a
    line are split again, and the rest of their text is not carried along."""
    at = F.collect_list(F.struct("line_no", "id")).alias("_at")
    at = scratch.save(places.groupBy(F.col("doc").alias("_doc"), F.col("row_h").alias("_row")).agg(at), "places")
    base = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_row"))
    found = base.join(maybe_broadcast(at), same).select(F.split("text", "\n", -1).alias("lines"), "_at")
    found = found.select(F.explode(F.transform("_at", lambda x: F.struct(x["id"].alias("id"), F.get("lines", x["line_no"]).alias("line")))).alias("x"))
    # rows that are equal in both give a line more than once
    return found.select("x.id", normal(F.col("x.line")).alias("norm")).groupBy("id").agg(F.min("norm").alias("norm"))


def duplicate_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """A row for each line that has an equal or similar line elsewhere.

    Columns: ``doc_id, line_no`` (from 0), ``keep_doc_id, keep_line_no`` (the line that stays: the first by document and
    place), ``group_size`` (lines in the component), ``kept``, ``n_chars`` (of the normalised line), ``row_h`` (the
    document's ``xxhash64(text)``, which tells rows that share an identifier apart).

    Lines are lower-cased with white space collapsed. Lines are signed where they are read; then equal ones are merged,
    with partial aggregation, so a line in a third of all documents is one row a task. Lines of fewer than 16 words are
    signed by their 5-character shingles: distinct lines that agree in one of ``bands`` bands of ``rows`` hashes are
    candidates (98.6 % of pairs at a similarity of 0.8, 99.9 % at 0.86 and more), and lines of at most 48 shingles take as
    many bands of 4 hashes besides. Lines of 12 and more words are signed by word marks, in 14 bands of 3; by reckoning, at
    six letters a word, 99.1 % of pairs at 0.8 whose edits are single letters spread evenly, and more where they lie
    together. Candidates link if the Jaccard similarity of their 5-character shingle sets is at least
    ``threshold``, compared in full; distributed union-find forms components. In a crowded band members are compared
    with leaders first, and then only pairs that are still in different components: inside the join, their 64 smallest
    hashes first, of which 41 must be common, then the whole sets.

    Lines without a character other than white space have no rows, and so have null and empty texts. A line with fewer
    than 5 characters is one shingle, so it links with equal lines only. A null identifier comes after all others and is
    returned as null. Rows that share an identifier are told apart by their texts; of rows that are equal in both, all
    keep a line that stays. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    percent = round(100 * threshold)
    lines = _lines(docs, id_col, text_col).withColumn("n_chars", F.char_length("norm"))
    # signed where they are read, as keys are much shorter than texts; places are kept, so texts are not split again
    read = scratch.save(with_band_keys(lines, bands, rows), "read")
    place = F.struct(F.col("doc").isNull().alias("no_doc"), "doc", "row_h", "line_no")
    merged = read.groupBy("id").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("keys").alias("keys"))
    every = scratch.save(merged, "signed")
    here = scratch.save(read.drop("keys"), "lines")
    scratch.drop(read)
    scratch.clean()

    keyed = every.select("id", F.explode("keys").alias("key"))
    alone = F.count(F.lit(1)).over(Window.partitionBy("key")) == 1
    members = scratch.save(keyed.withColumn("alone", alone).where(~F.col("alone")).select("key", "id"), "shared")
    distinct = scratch.save(every.select("id", "first", "copies"), "distinct")
    scratch.drop(every)
    scratch.clean()
    if members.isEmpty():
        linked = distinct.select("id", F.col("id").alias("component")).limit(0)
    else:
        wanted = scratch.save(members.select("id").distinct(), "wanted")
        texts = _texts(docs, distinct.join(maybe_broadcast(wanted), "id").select("id", "first.*"), id_col, text_col, scratch)
        texts = texts.select("id", "norm", F.array_distinct(F.sort_array(shingles(F.col("norm")))).alias("s"))
        low = F.transform(F.slice("s", 1, SKETCH), lambda x: F.hash(x))
        texts = scratch.save(texts.select("id", "norm", F.size("s").alias("n"), low.alias("sketch")), "texts")
        scratch.clean()

        def sizes(a: Column, b: Column, key: Column | None) -> Column:
            return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)

        def alike(t_a: Column, t_b: Column, n: Column) -> Column:
            return F.lit(100 + percent) * F.size(F.array_intersect(shingles(t_a), shingles(t_b))) >= F.lit(percent) * n

        def linked_lines(a: Column, b: Column) -> Column:
            common = F.size(F.array_intersect(a["sketch"], b["sketch"]))
            least, most = F.least(a["n"], b["n"]), F.greatest(a["n"], b["n"])
            # a small set is its own sketch, where two more are allowed for; beyond, the union's smallest are sampled
            whole = (100 + percent) * (common + 2) >= percent * (least + most)
            near = F.when(most <= SKETCH, whole).otherwise((least <= SKETCH) | (common >= AGREE))
            return near & alike(a["norm"], b["norm"], a["n"] + b["n"])

        def verify(pairs: DataFrame) -> DataFrame:
            a = texts.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("norm").alias("t_a"))
            b = texts.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("norm").alias("t_b"))
            same = alike(F.col("t_a"), F.col("t_b"), F.col("n_a") + F.col("n_b"))
            return pairs.join(a, "a").join(b, "b").where(same).select("a", "b")

        sized = members.join(texts.select("id", F.col("n").alias("size")), "id").select("key", "id", "size")
        detail = texts.select("id", F.struct("n", "sketch", "norm").alias("detail"))
        linked = link_groups(sized, verify, sizes, scratch, star_rounds=1, merge_groups=True, detail=detail, linked=linked_lines)
        scratch.clean()
    groups = distinct.select("id", "first", "copies").join(maybe_broadcast(linked), "id", "left")
    repeated = groups.where((F.col("copies") > 1) | F.col("component").isNotNull())
    repeated = repeated.select("id", "first", "copies", F.coalesce("component", "id").alias("label"))
    keepers = repeated.groupBy("label").agg(F.min("first").alias("keep"), F.sum("copies").alias("group_size"))
    keepers = keepers.where("group_size > 1")
    decided = scratch.save(repeated.select("id", "label").join(keepers, "label").select("id", "keep", "group_size"), "decided")
    same = F.col("doc").eqNullSafe(F.col("keep.doc")) & (F.col("row_h") == F.col("keep.row_h")) & (F.col("line_no") == F.col("keep.line_no"))
    return here.join(maybe_broadcast(decided), "id").select(
        F.col("doc").alias("doc_id"),
        "line_no",
        F.col("keep.doc").alias("keep_doc_id"),
        F.col("keep.line_no").alias("keep_line_no"),
        "group_size",
        same.alias("kept"),
        "n_chars",
        "row_h",
    )


def drop_duplicate_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, min_chars: int = 20
) -> DataFrame:
    """``docs`` without the lines of ``min_chars`` or more characters that ``duplicate_lines`` does not keep; the columns
    stay as they are. Shorter lines, such as list marks, say too little to be copies, and stay.

    A document that had words and loses them all is a copy of others and goes; documents that had none stay. The
    removed places of a text are one narrow row, joined by identifier and text hash, so rows that share an identifier,
    or have none, lose their own lines only.
    """
    scratch = Scratch(docs.sparkSession, "droplines")
    gone = duplicate_lines(docs, id_col=id_col, text_col=text_col, threshold=threshold).where(~F.col("kept") & (F.col("n_chars") >= min_chars))
    gone = gone.groupBy(F.col("doc_id").alias("_line_doc"), F.col("row_h").alias("_line_row")).agg(F.collect_set("line_no").alias("_line_gone"))
    gone = scratch.save(gone, "gone")
    scratch.clean()
    docs = replacing(docs, ["_line_doc", "_line_row", "_line_gone"])
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_line_doc")) & (F.xxhash64(text_col) == F.col("_line_row"))
    joined = docs.join(gone, same, "left")
    lines = F.split(F.col(text_col), "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_line_gone", i)), "\n")
    text = F.when(F.col("_line_gone").isNull(), F.col(text_col)).otherwise(left)
    emptied = F.col("_line_gone").isNotNull() & (F.trim(F.regexp_replace(left, r"\s+", " ")) == "")
    return joined.where(~emptied).withColumn(text_col, text).select(*[f"`{c}`" for c in docs.columns])
