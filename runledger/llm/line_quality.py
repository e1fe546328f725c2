"""Quality rules, lines first: lines that fail are removed, then documents that lose too much are rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import SPACES, WORD, let, packed, quoted, unpacked, write_through

# The rules for a line, as patterns that Java and RE2 read alike.
ENDS_WELL = "[.!?…。！？][\"'”’»)\\]]*[ \\t\\x0B\\f\\r]*\\z"
SHOUTS = "[!?]{2,}"
SYMBOL = "[#*$%&|<>]"
SEPARATOR = "[|»›•·]"
NAVIGATION = (
    "(?i)^[ \\t]*(skip to (main )?content|back to top|read more|next page|previous page|log in|sign in|sign up|share this)"
)
BOILERPLATE = (
    "(?i)(all rights reserved|cookie policy|privacy policy|use of cookies|terms of (use|service)|enable javascript|"
    "licensed under the|copyright \\(c\\)|©|lorem ipsum|subscribe to our|click here)"
)
MAX_SHOUTS, MIN_SYMBOLS, SYMBOLS_PER_5_WORDS, MIN_SEPARATORS = 3, 3, 1, 3
MAX_LOST_PERCENT = 50
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20


def line_fails(line: Column) -> Column:
    """True for a line that has words but breaks a rule.

    Punctuation: it must end as a sentence does, have fewer than three doubled
    marks, and no more symbols than a fifth of its words (three are free).
    Navigation: three separators or a known link text. Boilerplate: a known phrase.
    """
    symbols = F.regexp_count(line, F.lit(SYMBOL))
    punctuation = (
        ~F.regexp_like(line, F.lit(ENDS_WELL))
        | (F.regexp_count(line, F.lit(SHOUTS)) >= MAX_SHOUTS)
        | ((symbols >= MIN_SYMBOLS) & (5 * symbols > SYMBOLS_PER_5_WORDS * F.regexp_count(line, F.lit(WORD))))
    )
    navigation = (F.regexp_count(line, F.lit(SEPARATOR)) >= MIN_SEPARATORS) | F.regexp_like(line, F.lit(NAVIGATION))
    return punctuation | navigation | F.regexp_like(line, F.lit(BOILERPLATE))


def _repeated_words(grams: Column) -> Column:
    """How many words lie in windows that occur twice, given a number for each window."""

    def covered(ordered: Column) -> Column:
        def twin(at: Column) -> Column:
            own = F.get(ordered, at)["h"]
            return (F.get(ordered, at - 1)["h"].eqNullSafe(own)) | (F.get(ordered, at + 1)["h"].eqNullSafe(own))

        places = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), twin)
        starts = F.transform(places, lambda at: F.get(ordered, at)["at"])
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(s, s + WINDOW - 1)))))

    pairs = F.transform(grams, lambda h, at: F.struct(h.alias("h"), at.alias("at")))
    some = F.size(F.array_distinct(grams)) < F.size(grams)
    return F.when(some, let(F.array_sort(pairs), covered)).otherwise(F.lit(0)).cast("long")


def judge_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the figures of each text, its ``clean_text`` and ``kept``.

    Added, replacing columns so named: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines (with a word), n_bad_lines, chars, lost_chars (of lines
    with a word), base_failed, kept, clean_text. Lines without a word are neither
    judged nor counted and stay. A null text counts as empty: no words, base_failed,
    not kept, null clean_text. Texts are read whole, row by row, without a shuffle;
    equal rows get equal results and an empty table gives an empty one.
    """
    body = F.coalesce(F.col("row").getField(text), F.lit(""))
    base = packed(df).select(
        "row",
        body.alias("body"),
        F.regexp_extract_all(body, F.lit(f"({WORD})"), 1).alias("words"),
        F.split(body, "\n", -1).alias("lines"),
    )
    hashed = base.select(
        "row", "body", "words",
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
        F.transform(
            "lines",
            lambda x: F.struct(x.alias("line"), F.regexp_like(x, F.lit(WORD)).alias("full"), line_fails(x).alias("fails")),
        ).alias("judged"),
    )
    numbers = F.when(
        F.size("h") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("h") - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("h"), i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<long>"))
    windows = hashed.select(
        "row", "body", F.size("words").cast("long").alias("n_words"),
        numbers.alias("grams"),
        F.filter("judged", lambda x: x["full"]).alias("full"),
        F.filter("judged", lambda x: ~(x["full"] & x["fails"])).alias("good"),
    )
    chars = F.aggregate("full", F.lit(0).cast("long"), lambda a, x: a + F.length(x["line"]))
    lost = F.aggregate("full", F.lit(0).cast("long"), lambda a, x: a + F.when(x["fails"], F.length(x["line"])).otherwise(0))
    lines = F.transform("full", lambda x: x["line"])
    plain = F.length("body")
    figures = windows.select(
        "row", "n_words",
        (F.length(F.translate("body", SPACES, ""))).cast("long").alias("word_chars"),
        (plain - F.length(F.translate("body", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("grams")).alias("n_repeat_words"),
        F.size("full").cast("long").alias("n_lines"),
        F.size(F.filter("full", lambda x: x["fails"])).cast("long").alias("n_bad_lines"),
        chars.alias("chars"), lost.alias("lost_chars"),
        F.concat_ws("\n", F.transform("good", lambda x: x["line"])).alias("clean"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = figures.withColumn("failed", failed)
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_bad_lines chars lost_chars".split()
    return unpacked(
        judged,
        **{name: F.col(name) for name in names},
        base_failed=F.col("failed"),
        kept=~F.col("failed") & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("chars")),
        clean_text=F.when(F.col("row").getField(text).isNotNull(), F.col("clean")),
    )


def clean_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` that are kept, with their clean text and, where there is such a column, ``n_chars`` counted anew."""
    # Written before it is filtered: pushed down, the condition would copy the rules' expressions into every step below.
    whole = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("doc"), F.col(quoted(text)).alias("body"))
    judged = judge_lines(whole, "body").select("doc", "clean_text", "kept")
    judged = write_through(judged, "judged-lines").where("kept")
    made = {text: F.col("clean_text"), n_chars: F.length("clean_text").cast("long")}
    return judged.select(*[made.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
