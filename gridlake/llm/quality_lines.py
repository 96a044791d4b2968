"""Line-first cleaning: rules per line, failing lines go, documents that lose too much text are rejected.

Only DataFrame functions run on the rows. The text stays in its row: lines, words and word windows are arrays
inside it, so nothing is shuffled and a long or frequent text costs only its own length.

Cases: a null text has no lines and no words and fails the base rules; an empty table gives an empty result;
repeated rows are judged alike; extra columns are kept, and a clashing name is replaced by the operator's column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space of the word definition: 0x20 and 0x09-0x0D.
_WS = "[\\x20\\x09-\\x0D]"
_WS_CHARS = " \t\n\x0b\x0c\r"

#: Rules per line (fixed values).
NAV_SEPARATORS = r"[|›»•·→]"
SYMBOLS = r"[#*$%&|<>]"
TERMINAL = tuple(""".!?…。！？:;"'”’)]""")
BOILERPLATE = (
    r"(?i)\b(all rights reserved|cookies?|javascript|privacy policy|terms of (use|service)|click here|"
    r"sign (in|up)|log ?in|subscribe|share (this|on)|read more|lorem ipsum|powered by|back to top|skip to)\b"
)
MAX_BOILERPLATE_CHARS = 160
#: A line without end punctuation needs three words; three separators make a navigation line.
_WORD_CHAR = "[^\\x20\\x09-\\x0D]"
_THREE_WORDS = _WORD_CHAR + _WS + "+" + _WORD_CHAR + "+" + _WS + "+" + _WORD_CHAR
_MARKS = "[#*$%&|<>›»•·→]"
_NAV_MANY = f"(?:{NAV_SEPARATORS}[^|›»•·→]*+){{3}}"
#: A document keeps at least this share of its word characters, or it is rejected.
MIN_KEPT_SHARE = 0.5


def _words(text: Column) -> Column:
    """Words of a text; the empty string has none."""
    trimmed = F.btrim(text, F.lit(_WS_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _WS + "+"))


def _char_count(text: Column, pattern: str) -> Column:
    """Occurrences of a one-character class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def line_fails(line: Column) -> Column:
    """True for a line that has words and breaks the punctuation, navigation or boilerplate rule.

    Cheap tests stand first: words are split and counted only in lines that hold a symbol, separator or phrase.
    """
    n = F.size(_words(line))
    last = F.right(F.rtrim(line), F.lit(1))
    unfinished = ~last.isin(*TERMINAL) & ~line.rlike(_THREE_WORDS)
    symbols = _char_count(line, SYMBOLS) * 2 >= n
    navigation = line.rlike(_NAV_MANY) & (_char_count(line, NAV_SEPARATORS) * 4 >= n)
    marked = line.rlike(_MARKS) & (symbols & line.rlike(SYMBOLS) | navigation)
    boilerplate = (F.length(line) <= MAX_BOILERPLATE_CHARS) & line.rlike(BOILERPLATE)
    return line.rlike(_WORD_CHAR) & (unfinished | marked | boilerplate)


def clean_lines(df: DataFrame, text_col: str = "text", min_kept_share: float = MIN_KEPT_SHARE) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_failed_lines, kept_chars,
    clean_text, base_failed, kept`` to every row (columns of these names are replaced).

    ``clean_text`` has the lines that pass, joined by line feeds (null for a null text). ``kept`` is false if the
    base rules fail or less than ``min_kept_share`` of the word characters is left.
    """
    src = F.col(f"`{text_col}`")
    out = (
        df.withColumn("__t", F.coalesce(src, F.lit("")))
        .withColumn("__lines", F.split("__t", "\n"))
        .withColumn("__w", _words(F.col("__t")))
        .withColumn("n_words", F.size("__w").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("__w", "")).cast("long"))
        .withColumn("n_symbols", _char_count(F.col("__t"), SYMBOLS).cast("long"))
        .withColumn("n_dup_lines", _duplicate_lines("__lines"))
        .withColumn("__s", _sorted_windows("__w"))
        .withColumn("__f", F.expr(_REPEATED))
        .withColumn("n_repeat_words", F.expr(_COVERED))
        .withColumn("__good", F.filter("__lines", lambda x: ~line_fails(x)))
    )
    joined = F.array_join("__good", "\n")
    out = (
        out.withColumn("n_lines", F.when(src.isNull(), 0).otherwise(F.size("__lines")).cast("long"))
        .withColumn("n_failed_lines", (F.size("__lines") - F.size("__good")).cast("long"))
        .withColumn("clean_text", F.when(src.isNotNull(), joined))
        .withColumn("kept_chars", F.length(F.regexp_replace(F.coalesce("clean_text", F.lit("")), _WS + "+", "")).cast("long"))
        .withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
        .withColumn("kept", ~F.col("base_failed") & (F.col("kept_chars") >= F.col("word_chars") * F.lit(min_kept_share)))
    )
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines"]
    made += ["kept_chars", "clean_text", "base_failed", "kept"]
    kept_cols = [f"`{c}`" for c in df.columns if c.lower() not in made]
    # One struct per row through a generator: later filters on these columns read them, and don't repeat the work.
    return out.select(*kept_cols, F.inline(F.array(F.struct(*made))))


def _duplicate_lines(lines: str) -> Column:
    """Lines with a word that equal an earlier line: lines with a word, less the distinct ones."""
    with_word = F.filter(F.col(lines), lambda x: F.btrim(x, F.lit(_WS_CHARS)) != "")
    return (F.size(with_word) - F.size(F.array_distinct(with_word))).cast("long")


def _sorted_windows(words: str) -> Column:
    """(hash, position) of all three-word windows, sorted, so that equal windows stand side by side.

    Windows are compared by a 64-bit hash of their three words.
    """
    w = F.col(words)
    n = F.size(w)
    at = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(F.transform(at, lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("p"))))


#: Positions of windows that have an equal neighbour in the sorted array, in order.
_REPEATED = """
    sort_array(transform(filter(__s, (x, i) -> get(__s, i - 1).h = x.h or get(__s, i + 1).h = x.h), x -> x.p))"""

#: In order, each repeated window covers three words, or as many as lie before the next one.
_COVERED = """
    aggregate(transform(__f, (p, i) -> coalesce(least(3, get(__f, i + 1) - p), 3)), 0L, (a, x) -> a + x)"""
