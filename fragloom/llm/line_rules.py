"""Quality rules, lines first: clean a text line by line, then judge what that left of it.

Each line of a text goes through three kinds of rules. Punctuation: a line without the end of a
sentence, one with a symbol (`SYMBOL`) for every other word or more, and one that shouts, more
than a third of its words with an exclamation mark behind, fail. Navigation: a line of fewer than
three words fails, and one with a word that begins with a separator (`SEPARATOR`) for every five words.
Boilerplate: a line with one of `PHRASES` fails. Failing lines go. A document is rejected when it
fails a rule on its whole text (under `MIN_WORDS` words; over `REPEATED_PERCENT` per cent of its
words in 8-word windows that it has twice) or when more than `LOST_PERCENT` per cent of the
characters in its words went with the lines.

Everything is columns of one row: no shuffle, no Python on the executors, and a text that many
rows share is judged where each row lies. A text is the unit that one task holds; the windows
of a text are compared by 64 bits of hash, and sorted only where it has one twice.

A null text has no lines and no words and is rejected, like all texts under 20 words. A line ends
at "\\n" only. Lines with no word neither count nor are removed. Repeated rows and null ids are
judged like others and give as many rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fragloom.llm.common import quoted, table

# Both as characters of a regular expression.
WHITE = r"\x20\x09-\x0D"
SYMBOL = "[#*$%&|<>]"
SEPARATOR = rf"(^|[{WHITE}])([|/•·»›>]|::)"

#: A mark that ends a sentence, closing quotes and brackets after it, then white space or the end.
SENTENCE_END = r"""[.!?…。！？]["'”’»)\]]*([\x20\x09-\x0D]|$)"""
SHOUT = rf"!([{WHITE}]|$)"

#: In lower case, as they stand on web pages.
PHRASES = (
    "accept cookies",
    "all rights reserved",
    "click here",
    "enable javascript",
    "licensed under",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "sign in",
    "skip to content",
    "subscribe to",
    "terms of use",
)

WINDOW = 8
MIN_WORDS = 20
REPEATED_PERCENT = 30
LOST_PERCENT = 30
MIN_LINE_WORDS = 3


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often and in whatever lambda it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words between white space."""
    return F.filter(F.split(text, f"[{WHITE}]+"), lambda word: word != "")


def lines_of(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{WHITE}]"))


def letters(words: Column) -> Column:
    """How many characters words have."""
    return F.length(F.array_join(words, "")).cast("bigint")


def count_repeat_words(words: Column) -> Column:
    """How many words lie in a window of 8 words that these words hold twice or more."""

    def hashes(held: Column) -> Column:
        # Single words are looked up: a slice of an array costs as much as all of the array.
        last = F.size(held) - WINDOW
        each = F.sequence(F.lit(0), last)
        hashed = F.transform(each, lambda at: F.xxhash64(*(F.get(held, at + i) for i in range(WINDOW))))
        return F.when(last > 0, hashed).otherwise(F.array().cast("array<bigint>"))

    def covered(windows: Column) -> Column:
        # Sorting is for the few texts that have a window twice.
        placed = F.transform(windows, lambda hashed, at: F.struct(hashed.alias("hashed"), at.alias("at")))
        places = F.sort_array(bound(F.sort_array(placed), repeated))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
            F.aggregate(places, start, add, lambda sums: sums["n"])
        )

    def repeated(ordered: Column) -> Column:
        def place(window: Column, i: Column) -> Column:
            twin = [F.coalesce(window["hashed"] == F.get(ordered, j)["hashed"], F.lit(False)) for j in (i - 1, i + 1)]
            return F.when(twin[0] | twin[1], window["at"])

        return F.filter(F.transform(ordered, place), lambda at: at.isNotNull())

    def add(sums: Column, at: Column) -> Column:
        more = F.least(F.lit(WINDOW), at - sums["last"])
        return F.struct(at.alias("last"), (sums["n"] + more).alias("n"))

    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    return bound(bound(F.transform(words, lambda word: F.xxhash64(word)), hashes), covered).cast("bigint")


def line_passes(line: Column, words: Column) -> Column:
    """Whether a line passes all rules for lines."""
    n = F.size(words)
    count = lambda pattern: F.regexp_count(line, F.lit(pattern))
    punctuation = line.rlike(SENTENCE_END) & (2 * count(SYMBOL) < n) & (3 * count(SHOUT) <= n)
    boilerplate = bound(F.lower(line), lambda low: reduce(Column.__or__, [low.contains(p) for p in PHRASES]))
    return (n >= MIN_LINE_WORDS) & punctuation & (5 * count(SEPARATOR) < n) & ~boilerplate


def judge_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines_removed, kept_chars (characters in words of the lines that stay), cleaned (those lines), kept."""
    text = F.coalesce(documents[quoted(text_col)], F.lit(""))
    some = documents.select(documents[quoted(id_col)].alias("doc_id"), text.alias("text"))

    def judged(line: Column) -> Column:
        return bound(
            words_of(line),
            lambda words: F.struct(line.alias("line"), words.alias("words"), line_passes(line, words).alias("passes")),
        )

    lines = some.select(
        "doc_id",
        F.regexp_count("text", F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        F.transform(lines_of(F.col("text")), judged).alias("lines"),
    )

    def figures_of(lines: Column) -> Column:
        return bound(F.filter(lines, lambda line: line["passes"]), lambda left: of_all(lines, left))

    def of_all(lines: Column, left: Column) -> Column:
        texts = lines["line"]
        return F.struct(
            (F.size(texts) - F.size(F.array_distinct(texts))).cast("bigint").alias("n_dup_lines"),
            (F.size(lines) - F.size(left)).cast("bigint").alias("n_lines_removed"),
            letters(F.flatten(left["words"])).alias("kept_chars"),
            F.array_join(left["line"], "\n").alias("cleaned"),
            bound(F.flatten(lines["words"]), of_words).alias("of_words"),
        )

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            letters(words).alias("word_chars"),
            count_repeat_words(words).alias("n_repeat_words"),
        )

    figures = lines.select("doc_id", "n_symbols", bound(F.col("lines"), figures_of).alias("figures"))
    figures = figures.select("doc_id", "n_symbols", "figures.*").select("*", "of_words.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    lost = 100 * (F.col("word_chars") - F.col("kept_chars")) > LOST_PERCENT * F.col("word_chars")
    return figures.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        "n_lines_removed",
        "kept_chars",
        "cleaned",
        (~failed & ~lost).alias("kept"),
    )


def keep_clean(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of the documents that are kept, text without the lines that failed."""
    judged = judge_documents(documents, id_col, text_col)
    return judged.where("kept").select("doc_id", F.col("cleaned").alias("text"))


def op11_line_first_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its figures and whether it is kept."""
    judged = judge_documents(table(spark, sf_dir, "documents"))
    return judged.drop("cleaned")
