"""Document quality rules with cross-document line frequency per host.

Base rules count words, symbols, repeated lines and repeated five-word windows
inside one document. The cross-document rule hashes every normalised line,
counts the distinct texts of a host that hold it, and removes lines that more
than ``line_share`` percent of the host's distinct texts, and at least
``min_documents`` of them, contain. A document that loses more than
``lost_share`` percent of its words is depleted and rejected. Copies of one
text count once, so a group of exact copies does not deplete itself.

A null text has no words and fails the base rule, as an empty text does. A
null host is a host of its own. Repeated rows are judged alike. Very long
texts are judged whole. An empty table gives no rows. Only the named columns
of the input are read, so further columns cannot clash.

Lines and windows are compared by 64-bit hashes; repeated lines inside a
document are compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linespan.llm.common import WHITE, WHITE_CLASS, keyed, let, settle, whole_rows, words_of

# Characters that count as symbols, and the window's words.
SYMBOL_CLASS = "[#*$%&|<>]"
WINDOW = 5

MIN_WORDS = 10
REPEAT_SHARE = 20
MIN_DOCUMENTS = 10
# Boilerplate stands in some 2 to 13% of a large host's texts. The share keeps chance repeats out as a host grows.
LINE_SHARE = 1
LOST_SHARE = 50


def repeat_words(words: Column) -> Column:
    """Words covered by five-word windows that occur at least twice."""

    def of_windows(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW))),
        )
        return let(
            windows,
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)),
        )

    def covered(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(rows: Column) -> Column:
            return F.filter(
                rows,
                lambda row, i: F.coalesce(row["h"] == F.get(rows, i - 1)["h"], F.lit(False))
                | F.coalesce(row["h"] == F.get(rows, i + 1)["h"], F.lit(False)),
            )

        starts = let(ordered, lambda rows: F.array_sort(F.transform(repeated(rows), lambda row: row["i"])))
        # Each start covers its window up to the next start.
        return let(
            starts,
            lambda p: F.aggregate(
                F.transform(p, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - at, F.lit(WINDOW)))),
                F.lit(0),
                lambda total, x: total + x,
            ),
        )

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), of_windows)
    ).cast("long")


def measured(rows: DataFrame, text: Column) -> DataFrame:
    """Add the base counts and the lines' hashes and word counts."""
    content = F.coalesce(text, F.lit(""))
    lines = F.split(content, "\n")
    with_words = F.filter(lines, lambda line: F.length(F.btrim(line, F.lit(WHITE))) > 0)
    return (
        rows.withColumn("word_list", words_of(content))
        .withColumn("line_list", with_words)
        .select(
            *rows.columns,
            F.size("word_list").cast("long").alias("n_words"),
            F.char_length(F.regexp_replace(content, WHITE_CLASS, "")).cast("long").alias("word_chars"),
            (F.char_length(content) - F.char_length(F.regexp_replace(content, SYMBOL_CLASS, "")))
            .cast("long").alias("n_symbols"),
            (F.size("line_list") - F.size(F.array_distinct("line_list"))).cast("long").alias("n_dup_lines"),
            repeat_words(F.col("word_list")).alias("n_repeat_words"),
            F.transform(
                "line_list",
                lambda line: F.struct(
                    F.xxhash64(normal_line(line)).alias("line"), F.size(words_of(line)).alias("words")
                ),
            ).alias("lines"),
        )
    )


def normal_line(line: Column) -> Column:
    """A line without outer white space, in lower case."""
    return F.lower(F.btrim(line, F.lit(WHITE)))


def frequent_lines(lines: DataFrame, min_documents: int, line_share: int) -> DataFrame:
    """Lines above the limits. ``lines``: host, text_key, lines (hashes, words)."""
    texts = lines.select("host", "text_key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    held = (
        lines.select("host", "text_key", F.explode("lines.line").alias("line"))
        .distinct()
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_documents)
    )
    return held.join(texts, "host").where(F.col("n") * 100 > F.col("texts") * line_share).select("host", "line")


def judged(
    docs: DataFrame, *, key: str, text: Column, host: Column, min_documents: int = MIN_DOCUMENTS,
    line_share: int = LINE_SHARE, lost_share: int = LOST_SHARE,
) -> DataFrame:
    """Return key, the base counts, base_failed, words_lost and kept per row of ``docs``.

    ``key`` must differ between rows.
    """
    counts = settle(
        measured(
            docs.select(
                key,
                F.coalesce(F.concat(F.lit("h"), host), F.lit("none")).alias("host"),
                F.md5(F.coalesce(text, F.lit(""))).alias("text_key"),
                text.alias("content"),
            ),
            F.col("content"),
        ).drop("content"),
        "quality-counts",
    )
    frequent = frequent_lines(counts.select("host", "text_key", "lines"), min_documents, line_share)
    lost = (
        counts.select(key, "host", F.explode("lines").alias("l"))
        .select(key, "host", F.col("l.line").alias("line"), F.col("l.words").alias("words"))
        .join(frequent, ["host", "line"])
        .groupBy(key)
        .agg(F.sum("words").alias("lost"))
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_SHARE
    )
    words_lost = F.coalesce("lost", F.lit(0)).cast("long")
    return counts.drop("lines", "host", "text_key").join(lost, key, "left").select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), words_lost.alias("words_lost"),
        (~base_failed & (words_lost * 100 <= F.col("n_words") * lost_share)).alias("kept"),
    )


def kept_rows(docs: DataFrame, *, text: str = "text", host: str = "source") -> DataFrame:
    """Return the rows that pass, with the columns of ``docs``."""
    stored = keyed(docs, "quality-rows")
    verdicts = judged(stored, key="row_key", text=F.col(f"doc.`{text}`"), host=F.col(f"doc.`{host}`"))
    return whole_rows(stored, verdicts.where("kept"))


def without_frequent_lines(
    docs: DataFrame, *, text: str = "text", host: str = "source", min_documents: int = MIN_DOCUMENTS,
    line_share: int = LINE_SHARE,
) -> DataFrame:
    """Return the rows with ``clean_text``, the text without lines above the limits."""
    stored = keyed(docs, "quality-clean")
    content, place = F.col(f"doc.`{text}`"), F.col(f"doc.`{host}`")
    lines = stored.select(
        "row_key",
        F.coalesce(F.concat(F.lit("h"), place), F.lit("none")).alias("host"),
        F.md5(F.coalesce(content, F.lit(""))).alias("text_key"),
        F.transform(
            F.filter(F.split(F.coalesce(content, F.lit("")), "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0),
            lambda x: F.struct(F.xxhash64(normal_line(x)).alias("line")),
        ).alias("lines"),
    )
    frequent = frequent_lines(lines, min_documents, line_share)
    removed = (
        lines.select("row_key", "host", F.explode("lines.line").alias("line"))
        .join(frequent, ["host", "line"])
        .groupBy("row_key")
        .agg(F.collect_set("line").alias("gone"))
    )
    left = F.filter(
        F.split(content, "\n"),
        lambda x: (F.length(F.btrim(x, F.lit(WHITE))) == 0)
        | ~F.array_contains("gone", F.xxhash64(normal_line(x))),
    )
    rows = stored.join(removed, "row_key", "left")
    return rows.select("doc.*", F.when(F.col("gone").isNull(), content).otherwise(F.array_join(left, "\n")).alias("clean_text"))
