"""Quality rules: a threshold table compiled into one projection, without user functions.

``signals`` measures every text; ``verdict`` turns a table of :class:`Rule` into one boolean
expression over those measures. No shuffle, no Python.

Defined results: a null text has no words and is measured like an empty one (it fails
``n_words``); repeated rows are measured each on its own; an empty table gives an empty table.
All input columns are kept; one that has the name of a measure is replaced by it, and
``apply_rules(keep=...)`` names the input columns to carry, so nothing can clash by surprise.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

# Frequent function words, written in lower case; upper-case text has none of them.
STOP_WORDS = (
    # English
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "on",
    "be", "by", "at", "an", "are", "this", "from", "or", "not", "have",
    # German
    "der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist",
    "im", "dem", "nicht", "ein", "eine", "als", "auch",
    # French
    "de", "la", "le", "les", "et", "des", "en", "un", "une", "du", "que", "est", "pour", "qui",
    "dans", "par", "plus", "pas", "sur", "avec", "au",
    # Spanish
    "el", "los", "se", "las", "por", "con", "para", "es", "como", "más", "una", "del", "al",
    "lo", "su",
)


class Rule(NamedTuple):
    """Keep a text if ``low <= measure <= high``; asked only of texts of ``min_words`` words."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: Fails that hold whatever else is configured.
BASE_RULES = (
    Rule("too_short", "n_words", low=10),
    Rule("repeated_windows", "100 * n_repeat_words - 20 * n_words", high=0),
)

#: The method's own table. Ratios are written as products, so that no division is needed.
RULES = (
    Rule("mean_word_low", "word_chars - 1.5 * n_words", low=0),
    Rule("mean_word_high", "word_chars - 25 * n_words", high=0),
    Rule("symbols", "n_symbols - 0.3 * n_words", high=0),
    Rule("stop_words", "n_stop_words - 0.02 * n_words", low=0, min_words=50),
    Rule("repeated_lines", "n_dup_lines - 0.5 * n_lines", high=0),
)


def words(text: Column) -> Column:
    """Maximal runs without ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def _windows(n_words: str, word_list: str) -> Column:
    """Hashes of all windows; collisions of 64 bits within one text are not expected."""
    inside = ", ".join(f"{word_list}[i + {k}]" for k in range(WINDOW))
    return F.expr(
        f"CASE WHEN {n_words} >= {WINDOW} THEN transform(sequence(0, {n_words} - {WINDOW}), "
        f"i -> xxhash64({inside})) ELSE array() END"
    )


def signals(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) and the measures of each whole text."""
    keep = list(docs.columns if keep is None else keep)
    names = (
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words",
        "n_repeat_words",
    )
    kept = [F.col(f"`{c}`") for c in keep if c not in names]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    first = docs.select(*kept, F.struct(
        words(body).alias("w"), body.alias("t"),
        F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    ).alias("_m"))
    # Each step reads arrays of the one before as columns, never as an expression in a lambda.
    counted = first.select(
        *kept,
        F.col("_m.w").alias("_w"),
        F.size("_m.w").alias("_n"),
        F.expr("length(array_join(_m.w, ''))").cast("long").alias("word_chars"),
        F.regexp_count("_m.t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("_m.lines").cast("long").alias("n_lines"),
        (F.size("_m.lines") - F.size(F.array_distinct("_m.lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_m.w", lambda x: x.isin(*dict.fromkeys(STOP_WORDS)))).cast("long")
        .alias("n_stop_words"),
    )
    measured = [
        F.col("_n").cast("long").alias("n_words"),
        *(F.col(c) for c in names[1:6]),
    ]
    hashed = counted.select(*kept, *measured, _windows("_n", "_w").alias("_h"))
    passed = [F.col(c) for c in names[:6]]
    # Texts without a repeated window, nearly all, skip the sort.
    ordered = hashed.select(*kept, *passed, F.expr(
        "CASE WHEN size(array_distinct(_h)) < size(_h) "
        "THEN sort_array(transform(_h, (h, i) -> struct(h, i))) ELSE array() END"
    ).alias("_s"))
    starts = ordered.select(*kept, *passed, F.expr(
        "sort_array(transform(filter(_s, (e, k) -> "
        "(k > 0 AND e.h = _s[k - 1].h) OR (k + 1 < size(_s) AND e.h = _s[k + 1].h)), e -> e.i))"
    ).alias("_p"))
    repeats = F.expr(
        f"aggregate(transform(_p, (p, k) -> least({WINDOW}, "
        f"coalesce(get(_p, k + 1) - p, {WINDOW}))), 0L, (s, x) -> s + x)"
    ).alias("n_repeat_words")
    # Filters are not pushed through a generator. Pushed further they would put the arrays back
    # into the lambdas that read them, to be made anew for each element.
    return starts.select(*kept, F.inline(F.array(F.struct(*passed, repeats))))


def verdict(rules: Sequence[Rule]) -> Column:
    """True where every rule of the table holds."""
    held = F.lit(True)
    for rule in rules:
        measure, bounds = F.expr(rule.measure), F.lit(True)
        if rule.low is not None:
            bounds = bounds & (measure >= rule.low)
        if rule.high is not None:
            bounds = bounds & (measure <= rule.high)
        if rule.min_words:
            bounds = bounds | (F.col("n_words") < rule.min_words)
        held = held & bounds
    return held


def apply_rules(
    docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for each row."""
    measured = signals(docs, text, keep)
    others = [f"`{c}`" for c in measured.columns if c not in ("base_failed", "kept")]
    base = verdict(BASE_RULES)
    return measured.select(
        *others, (~base).alias("base_failed"), (base & verdict(rules)).alias("kept")
    )


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows that pass, with the columns they came with."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
                        F.col(f"`{text}`").alias("_text"))
    return apply_rules(whole, "_text", rules, keep=["_row"]).where("kept").select("_row.*")
