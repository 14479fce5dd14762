"""Quality rules: a threshold table compiled into Spark projections, without user functions.

Every measure is row-local (no shuffle, no Python): lengths, symbol counts, stop-word share, repeated lines
and repeated five-word windows.  ``RULES`` is the threshold table; ``compile_rules`` turns it into one
projection that yields a verdict and the names of the failed rules.

Defined cases: a null text counts as empty (no words, so the base rule fails); ids may be null or repeated,
each row is judged alone; ratios over nothing are 0; other columns of the input do not matter, whatever
their names.  Measures count whole texts; a hash of a window only decides whether the exact count of
repeated windows has to run at all.  The stop words are those of four languages, so their share is held only against
texts of ``SHARE_WORDS`` words or more, mostly in Latin letters, whose ``lang`` (where there is one) names one of the four
or none; a Latin text in another language without a ``lang`` is still judged by them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardsmith.llm.common import fresh, words_of

WINDOW = 5

# Frequent function words of the corpus languages (English, French, German, Spanish).
STOP_WORDS = (
    "a", "and", "are", "as", "at", "be", "by", "for", "from", "have", "in", "is", "it", "of", "on", "that", "the", "this", "to", "was", "with",
    "dans", "de", "des", "en", "est", "et", "la", "le", "les", "ou", "que", "un", "une",
    "das", "den", "der", "die", "ein", "ist", "nicht", "mit", "und", "von", "zu",
    "como", "con", "del", "el", "las", "los", "no", "para", "por", "se", "una", "y",
)


# What a ``lang`` column calls these languages, and what it says where it knows none.
STOP_WORD_LANGS = ("en", "eng", "fr", "fra", "fre", "de", "deu", "ger", "es", "spa")
NO_LANG = ("", "und", "unknown")
SHARE_WORDS = 50  # in fewer words, a share of 0.02 is less than one word


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; a bound that is None does not apply."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# The threshold table: bounds far from those of running prose, so only clear outliers fail.
RULES = (
    Rule("too_few_words", "n_words", low=10),
    Rule("repeated_windows", "repeat_ratio", high=0.20),
    Rule("mean_word_length", "mean_word", low=2.0, high=20.0),
    Rule("symbols", "symbol_ratio", high=0.10),
    Rule("repeated_lines", "dup_line_ratio", high=0.30),
    Rule("stop_words", "stop_ratio", low=0.02),
    Rule("words_without_letters", "letter_ratio", low=0.60),
)
BASE_RULES = ("too_few_words", "repeated_windows")


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def _measures(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` plus a struct column ``out`` of measures; each step is a projection over the one before."""
    w, lines, grams, starts, sym, words, chars, n_lines, dup, stop, letter, rep = fresh(
        df, "words", "lines", "grams", "starts", "sym", "n", "chars", "n_lines", "dup", "stop", "letter", "rep")
    base = df.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    keep = [F.col(f"`{c}`") for c in base]
    step = df.select(
        *keep,
        words_of(F.col(text_col)).alias(w),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias(sym),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(lines),
    )
    n = F.size(w)
    item = lambda i, k: F.get(F.col(w), i + k)
    index = F.sequence(F.lit(0), n - WINDOW)
    step = step.select(
        *keep, w, sym,
        n.cast("long").alias(words),
        F.length(F.array_join(w, "")).cast("long").alias(chars),
        F.size(lines).cast("long").alias(n_lines),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias(dup),
        F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias(stop),
        F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))).cast("long").alias(letter),
        F.when(n >= WINDOW, F.transform(index, lambda i: F.xxhash64(*[item(i, k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")).alias(grams),
    )
    # Only a text whose window hashes repeat is looked at again, now with the windows themselves, sorted.
    exact = F.sort_array(F.transform(index, lambda i: F.struct(F.concat_ws(" ", *[item(i, k) for k in range(WINDOW)]).alias("g"), i.alias("i"))))
    measured = [sym, words, chars, n_lines, dup, stop, letter]
    step = step.select(*keep, *measured, F.when(F.size(F.array_distinct(grams)) < F.size(grams), exact).alias(starts))
    s = F.col(starts)
    at = lambda k: F.get(s, k)["g"]
    twice = F.filter(s, lambda x, k: F.coalesce(x["g"] == at(k - 1), F.lit(False)) | F.coalesce(x["g"] == at(k + 1), F.lit(False)))
    step = step.select(*keep, *measured, F.array_sort(F.transform(twice, lambda x: x["i"])).alias(starts))
    # A start covers its window up to the next start: the words in repeated windows, each counted once.
    covered = F.aggregate(
        F.transform(s, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    c = F.col
    step = step.select(*keep, *measured, F.coalesce(covered, F.lit(0)).cast("long").alias(rep))
    return step.select(*keep, F.struct(
        c(words).alias("n_words"), c(chars).alias("word_chars"), c(sym).alias("n_symbols"),
        c(dup).alias("n_dup_lines"), c(rep).alias("n_repeat_words"),
        _ratio(c(chars), c(words)).alias("mean_word"), _ratio(c(sym), c(chars)).alias("symbol_ratio"),
        _ratio(c(dup), c(n_lines)).alias("dup_line_ratio"), _ratio(c(stop), c(words)).alias("stop_ratio"),
        _ratio(c(letter), c(words)).alias("letter_ratio"), _ratio(c(rep), c(words)).alias("repeat_ratio"),
        ((c(words) < 10) | (100 * c(rep) > 20 * c(words))).alias("base_failed"),
        # Not deterministic, so a filter on the verdict stays above: pushed down, it would copy every measure into itself.
        F.monotonically_increasing_id().alias("row"),
    ).alias(out))


def _listed_language(measures: str, text: Column, lang: Column | None) -> Column:
    """Whether the share of stop words tells something: enough words, mostly Latin letters, and no ``lang`` besides the listed ones."""
    told = F.lit(True)
    if lang is not None:
        code = F.coalesce(F.lower(F.btrim(F.split(lang, "[-_]").getItem(0))), F.lit(""))
        told = code.isin(*STOP_WORD_LANGS, *NO_LANG)
    latin = 2 * F.regexp_count(text, F.lit(r"\p{IsLatin}")) > F.regexp_count(text, F.lit(r"\p{L}"))
    return (F.col(measures)["n_words"] >= SHARE_WORDS) & told & latin


def compile_rules(measures: str, rules: tuple[Rule, ...] = RULES, only: dict[str, Column] | None = None) -> Column:
    """Names of the rules that a row fails, as one expression over the struct ``measures``; ``only`` says by name where a rule applies."""
    failed = []
    for r in rules:
        m = F.col(measures)[r.measure]
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (m < r.low)
        if r.high is not None:
            bad = bad | (m > r.high)
        if only and r.name in only:
            bad = bad & only[r.name]
        failed.append(F.when(bad, F.lit(r.name)))
    return F.array_compact(F.array(*failed))


def _passes(measures: str, failed: Column) -> Column:
    m = F.col(measures)
    return ~m["base_failed"] & (F.size(failed) == 0) & (m["row"] >= 0)


def _private(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    lang = F.col(f"`{lang_col}`").cast("string") if lang_col in df.columns else F.lit(None).cast("string")
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), lang.alias("lang"))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, lang_col: str = "lang",
                   by_language: bool = True) -> DataFrame:
    """One row per input row: id, measures, ``base_failed``, ``kept`` and ``failed_rules`` (names, in table order).

    ``by_language``: the rule ``stop_words`` judges only texts that can be in a listed language and are long enough.
    """
    m = _measures(_private(docs, id_col, text_col, lang_col), "text", "m")
    only = {"stop_words": _listed_language("m", F.col("text"), F.col("lang"))} if by_language else None
    m = m.select("doc_id", "m", compile_rules("m", rules, only).alias("failed_rules"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    ratios = ["mean_word", "symbol_ratio", "dup_line_ratio", "stop_ratio", "letter_ratio"]
    return m.select(
        "doc_id", *[F.col("m")[c].alias(c) for c in counts],
        _passes("m", F.col("failed_rules")).alias("kept"),
        *[F.col("m")[c].alias(c) for c in ratios], "failed_rules")


def keep_quality(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass every rule, with their columns as they were; stop words are judged ``by_language``."""
    (out,) = fresh(docs, "quality")
    m = _measures(docs, text_col, out)
    lang = F.col(f"`{lang_col}`").cast("string") if lang_col in docs.columns else None
    only = {"stop_words": _listed_language(out, F.col(text_col), lang)}
    return m.where(_passes(out, compile_rules(out, rules, only))).select(*[F.col(f"`{c}`") for c in docs.columns])


