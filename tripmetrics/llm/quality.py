"""Quality rules, lines first, in DataFrame functions only.

Each line is judged by itself: punctuation (symbols, shouting), navigation (menus),
boilerplate, stutter. Failing lines are removed. A document is rejected if it fails the base
rules on its words, or loses too much of its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as f

from tripmetrics.llm.spans import let

WORD = r"[^ \t-\r]+"
SPACE = r"[ \t-\r]+"
SYMBOL = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Line rules: a symbol for so many characters is too much; as is an exclamation mark.
SYMBOL_EVERY = 16
SHOUT_EVERY = 10
MENU_SEPARATORS = 2
BOILERPLATE = (
    r"(?i)\b(?:cookies?|javascript|terms of (?:use|service)|privacy policy|all rights reserved"
    r"|sign (?:in|up)|log ?in|subscribe|click here|read more|share this|skip to content)\b"
)
#: A word said so often in a row is a stutter; half of a line may be stutter.
STUTTER = r"(?:^|(?<= ))(\S+)(?: \1){3,}(?= |$)"
#: A line of boilerplate is short; a long one that only mentions it stays.
BOILERPLATE_CHARS = 160
MAX_LOST_PERCENT = 50


def words(text: Column) -> Column:
    return f.regexp_extract_all(text, f.lit(WORD), f.lit(0))


def lines(text: Column) -> Column:
    """The lines that have a word."""
    return f.filter(f.split(text, "\n", -1), lambda line: line.rlike(WORD))


def repeated_words(word: Column) -> Column:
    """Words inside windows of eight words that occur twice or more, first ones included.

    Most texts repeat no window, which distinct hashes prove. Only for the others are windows
    compared as text: sorted, so that equal ones are neighbours.
    """
    count = f.size(word)
    starts = f.sequence(f.lit(1), count - (WINDOW - 1))
    hashes = f.transform(starts, lambda i: f.xxhash64(f.slice(word, i, WINDOW)))
    unique = let(hashes, lambda h: f.size(f.array_distinct(h)) == f.size(h))
    return f.when((count <= WINDOW) | unique, 0).otherwise(_covered(word, starts)).cast("bigint")


def _covered(word: Column, starts: Column) -> Column:
    windows = f.array_sort(
        f.transform(
            starts,
            lambda i: f.struct(
                f.array_join(f.slice(word, i, WINDOW), " ").alias("w"), i.alias("i")
            ),
        )
    )

    def repeated(sorted_windows: Column) -> Column:
        def twin(k: Column) -> Column:
            here = f.get(sorted_windows, k)["w"]
            last = f.get(sorted_windows, f.greatest(k - 1, f.lit(0)))["w"]
            following = f.get(sorted_windows, k + 1)["w"]
            return ((k > 0) & (here == last)) | f.coalesce(here == following, f.lit(False))

        places = f.sequence(f.lit(0), f.size(sorted_windows) - 1)
        return f.array_sort(
            f.transform(f.filter(places, twin), lambda k: f.get(sorted_windows, k)["i"])
        )

    def width(positions: Column) -> Column:
        def new(j: Column) -> Column:
            gap = f.get(positions, j + 1) - f.get(positions, j)
            return f.least(f.lit(WINDOW), f.coalesce(gap, f.lit(WINDOW)))

        places = f.sequence(f.lit(0), f.size(positions) - 1)
        counted = f.aggregate(f.transform(places, new), f.lit(0), lambda a, b: a + b)
        return f.when(f.size(positions) == 0, 0).otherwise(counted)

    return let(let(windows, repeated), width)


def bad_line(line: Column) -> Column:
    """Whether a line fails one of the rules."""
    size = f.length(line)
    symbols = f.regexp_count(line, f.lit(SYMBOL)) * SYMBOL_EVERY > size
    shouting = f.regexp_count(line, f.lit("!")) * SHOUT_EVERY > size
    menu = f.regexp_count(line, f.lit(r" [|»·] ")) > MENU_SEPARATORS
    stutter = f.length(f.regexp_replace(line, STUTTER, "")) * 2 < size
    boilerplate = (size <= BOILERPLATE_CHARS) & line.rlike(BOILERPLATE)
    return symbols | shouting | menu | boilerplate | stutter


def assess(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the base measures, base_failed, kept, lost_chars, ``clean_text``.

    Null counts as no text: no words, so the base rules fail. Repeated rows are judged alike.
    Texts may be as long as they like; an empty table gives no rows.
    Only doc_id and text are read. ``clean_text`` is the lines that pass, joined by line feeds.
    """
    text = f.coalesce("text", f.lit(""))
    measured = (
        docs.select("doc_id", text.alias("text"))
        .select(
            "doc_id",
            "text",
            words(f.col("text")).alias("words"),
            lines(f.col("text")).alias("lines"),
        )
        .select(
            "doc_id",
            f.size("words").cast("bigint").alias("n_words"),
            f.length(f.regexp_replace("text", SPACE, "")).cast("bigint").alias("word_chars"),
            f.regexp_count("text", f.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
            (f.size("lines") - f.size(f.array_distinct("lines")))
            .cast("bigint")
            .alias("n_dup_lines"),
            let(f.col("words"), repeated_words).alias("n_repeat_words"),
            "lines",
            f.filter("lines", lambda line: ~bad_line(line)).alias("good"),
        )
    )
    chars = lambda parts: f.aggregate(
        parts, f.lit(0).cast("bigint"), lambda n, line: n + f.length(line)
    )
    failed = (f.col("n_words") < MIN_WORDS) | (
        100 * f.col("n_repeat_words") > MAX_REPEAT_PERCENT * f.col("n_words")
    )
    return (
        measured.withColumn("base_failed", failed)
        .withColumn("line_chars", chars(f.col("lines")))
        .withColumn("lost_chars", f.col("line_chars") - chars(f.col("good")))
        .withColumn(
            "kept",
            ~f.col("base_failed")
            & (100 * f.col("lost_chars") <= MAX_LOST_PERCENT * f.col("line_chars")),
        )
        .withColumn("clean_text", f.array_join("good", "\n"))
        .drop("lines", "good", "line_chars")
    )


def clean(docs: DataFrame) -> DataFrame:
    """doc_id and the cleaned text of the documents that stay."""
    return assess(docs).filter("kept").select("doc_id", f.col("clean_text").alias("text"))
