"""Line-first cleaning: judge lines, drop those that fail, reject texts that lose too much.

Only DataFrame expressions over one row at a time: no shuffle, so no key can be hot and the
plan is one scan and one projection whatever the size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardline.llm.text import SEPARATORS, words

#: Characters counted as symbols by the base statistics (fixed by the contract).
SYMBOLS = "#*$%&|<>"
#: Marks that prose rarely has; a line of which they make a large share fails.
MARKS = SYMBOLS + "!=_~^{}[]\\+@"
#: Marks between the entries of menus and breadcrumbs.
MENU_MARKS = "|»›•·"
#: Lower-case phrases of notices that surround articles.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "use of cookies",
    "uses cookies",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_MARK_PERCENT = 12
MIN_MENU_MARKS = 3
MIN_SHOUTED_WORDS = 4
MAX_LOST_PERCENT = 30


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _dense(text: Column) -> Column:
    """Code points that are not white space."""
    return F.char_length(_without(text, SEPARATORS))


def _wordy(line: Column) -> Column:
    return F.trim(line, F.lit(SEPARATORS)) != ""


def _has_phrase(lowered: Column, phrases: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(lowered, F.lit(phrase))
    return found


def line_fails(
    line: Column,
    *,
    max_mark_percent: int = MAX_MARK_PERCENT,
    min_menu_marks: int = MIN_MENU_MARKS,
    min_shouted_words: int = MIN_SHOUTED_WORDS,
    boilerplate: tuple[str, ...] = BOILERPLATE,
    notices: Column | None = None,
) -> Column:
    """Whether a line breaks the punctuation, navigation or boilerplate rule.

    Punctuation: marks beyond ``max_mark_percent`` of its characters, or a line of several words
    all in capitals. Navigation: several menu marks. Boilerplate: one of the phrases.
    A line without words passes: it holds no text to lose. ``notices`` false tells that no line
    of the text has a phrase.
    """
    marks = F.char_length(line) - F.char_length(_without(line, MARKS))
    punctuation = 100 * marks > max_mark_percent * _dense(line)
    shouted = (
        (line == F.upper(line))
        & (line != F.lower(line))
        & (F.char_length(line) - F.char_length(_without(line, " ")) >= min_shouted_words - 1)
    )
    navigation = F.char_length(line) - F.char_length(_without(line, MENU_MARKS)) >= min_menu_marks
    phrase = (F.lit(True) if notices is None else notices) & _has_phrase(F.lower(line), boilerplate)
    return _wordy(line) & (punctuation | shouted | navigation | phrase)


def _windows(size: Column, word: Column) -> Column:
    """A 64-bit hash of each run of three words."""
    return F.when(
        size >= 3,
        F.transform(F.sequence(F.lit(0), size - 3), lambda i: F.xxhash64(word[i], word[i + 1], word[i + 2])),
    ).otherwise(F.array().cast("array<bigint>"))


def _placed(windows: Column) -> Column:
    """Sorted pairs (window, place) of a text in which a window occurs twice, else null."""
    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(pairs))


def _repeat_words(placed: Column) -> Column:
    """Words inside windows that occur twice or more: equal windows are neighbours in the order."""
    n = F.size(placed)
    both = F.zip_with(
        F.slice(placed, F.lit(1), n - 1),
        F.slice(placed, F.lit(2), n - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    starts = F.array_distinct(F.flatten(F.filter(both, lambda p: p.isNotNull())))
    covered = F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))
    return F.when(placed.isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(covered)))


def score_rules(
    docs: DataFrame,
    *,
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    max_lost_percent: int = MAX_LOST_PERCENT,
    **line_rules,
) -> DataFrame:
    """Input columns under ``row`` with statistics, cleaned text and verdict beside them.

    Columns: row (struct of all input columns, so none can clash), n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_failed_lines, lost_chars (long), cleaned (string),
    base_failed, kept (boolean). A null text counts as empty: no words, so base_failed. An empty
    table gives an empty result; repeated rows are judged one by one.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    base = row.withColumn("body", F.coalesce(F.col("row")[text], F.lit("")))
    body = F.col("body")
    # No line can fail in a text without marks, a line in capitals or a phrase: most texts stop here.
    suspect = (
        (F.translate("body", MARKS + MENU_MARKS, "") != body)
        | F.col("notices")
        | F.rlike(body, F.lit(r"(?m)^[^\p{Ll}\n]*\p{Lu}[^\p{Ll}\n]*$"))
    )
    phrases = line_rules.get("boilerplate", BOILERPLATE)
    split = (
        base.withColumn("lowered", F.lower(body))
        .withColumns({
            "word": words(body),
            "line": F.split("body", "\n"),
            "notices": _has_phrase(F.col("lowered"), phrases),
        })
        .withColumns({
            "n": F.size("word"),
            "wordy": F.filter("line", _wordy),
            "fails": F.when(
                suspect, F.transform("line", lambda x: line_fails(x, notices=F.col("notices"), **line_rules))
            ),
        })
        .withColumns({
            "window": _windows(F.col("n"), F.col("word")),
            "cleaned": F.when(
                F.exists("fails", lambda x: x),
                F.array_join(F.filter("line", lambda x, i: ~F.col("fails")[i]), "\n"),
            ).otherwise(body),
        })
        .withColumn("placed", _placed(F.col("window")))
    )
    measures = {
        "n_words": F.col("n"),
        "word_chars": _dense(body),
        "n_symbols": F.char_length("body") - F.char_length(_without(body, SYMBOLS)),
        "n_dup_lines": F.size("wordy") - F.size(F.array_distinct("wordy")),
        "n_repeat_words": _repeat_words(F.col("placed")),
        "n_failed_lines": F.coalesce(F.size(F.filter("fails", lambda x: x)), F.lit(0)),
        "lost_chars": F.when(F.col("cleaned") == body, F.lit(0)).otherwise(_dense(body) - _dense(F.col("cleaned"))),
    }
    told = [value.cast("long").alias(name) for name, value in measures.items()]
    # Out of a generator the measures are values: a filter on them is not moved below and
    # does not make words and windows anew for each element.
    measured = split.select("row", F.explode_outer(F.array(F.struct(*told, "cleaned"))).alias("m")).select("row", "m.*")
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    return measured.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= max_lost_percent * F.col("word_chars"))
    )


def clean_documents(docs: DataFrame, *, text: str = "text", **rules) -> DataFrame:
    """Documents that pass, with failing lines taken out of their text; all other columns stay.

    ``n_chars``, where the table has it, is counted anew.
    """
    scored = score_rules(docs, text=text, **rules).filter("kept")
    new = {text: F.col("cleaned"), "n_chars": F.char_length("cleaned").cast("long")}
    return scored.select(*[
        (new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns
    ])
