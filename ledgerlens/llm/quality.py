"""Quality rules as a short-circuit cascade, in DataFrame functions only.

:func:`quality_features` adds one row's figures; :func:`plan_cascade`
estimates, on a sample, what each rule costs and how much it rejects, and
orders the rules by rejection per cost; :func:`rejected` evaluates them in
that order as one ``OR`` chain, which stops at the first rule that rejects.
The order changes the cost only, never the verdict.

Defined cases: a null or empty text has no words (all figures 0) and fails
``few_words``; repeated rows are judged alike; extra columns are kept, those
named like a figure give way. Rules of equal worth keep their given order. A text of any length
is one row, whose words and windows are arrays of that row. An empty table
gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import SPACE, stored, unpacked, whole_row, words

WINDOW = 8
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``reject`` tells, from the prepared columns, whether a text is refused."""
    name: str
    reject: Callable[[], Column]


def _prepared(df: DataFrame, text: Column, without: tuple[str, ...] = ()) -> DataFrame:
    """The row, its text, its words as ``_w``, their count as ``_n``, and the
    words joined as ``_c``."""
    out = df.select(whole_row(df, without), text.alias("_text"), words(text).alias("_w"))
    return out.withColumn("_n", F.size("_w").cast("long")).withColumn("_c", F.array_join("_w", ""))


def n_symbols() -> Column:
    return F.regexp_count(F.col("_c"), F.lit(SYMBOLS)).cast("long")


def n_marks() -> Column:
    return F.regexp_count(F.col("_c"), F.lit("!")).cast("long")


def lines(text: Column) -> Column:
    """The \\n-split lines that have a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: F.btrim(s, F.lit(SPACE)) != "")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return F.transform(F.array(lines(text)), lambda a: F.size(a) - F.size(F.array_distinct(a)))[0].cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _pairs(a: Column, gap: int) -> Column:
    """Hash of each value with the one ``gap`` places on."""
    size = F.size(a) - gap
    return F.zip_with(F.slice(a, F.lit(1), size), F.slice(a, F.lit(1 + gap), size), lambda x, y: F.xxhash64(x, y))


def _covered(starts: Column) -> Column:
    """Words covered by the windows that begin at the ascending ``starts``."""
    nexts = F.slice(starts, F.lit(2), F.size(starts))
    gaps = F.zip_with(F.slice(starts, F.lit(1), F.size(starts) - 1), nexts, lambda a, b: F.least(b - a, F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(WINDOW), lambda acc, g: acc + g).cast("long")


def _repeat_starts(grams: Column) -> Column:
    """Ascending positions of the windows whose hash occurs more than once."""
    placed = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(a: Column) -> Column:
        last = F.size(a) - 1
        return F.array_sort(F.filter(F.transform(a, lambda x, k: F.when(
            ((k > 0) & (F.get(a, k - 1)["h"] == x["h"])) | ((k < last) & (F.get(a, k + 1)["h"] == x["h"])), x["i"])),
            lambda i: i.isNotNull()))

    return _let(placed, twice)


def n_repeat_words() -> Column:
    """Words in 8-word windows found twice or more in the text.

    Window hashes are built by doubling (pairs, fours, eights). Only a text
    in which a hash repeats has its windows sorted to find and merge them.
    """
    def of(words_: Column) -> Column:
        one = F.transform(words_, lambda w: F.xxhash64(w))
        return _let(_let(_let(_let(one, lambda a: _pairs(a, 1)), lambda a: _pairs(a, 2)), lambda a: _pairs(a, 4)),
                    lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long"))
                    .otherwise(_let(_repeat_starts(g), _covered)))

    return F.when(F.col("_n") <= WINDOW, F.lit(0).cast("long")).otherwise(of(F.col("_w")))


#: Base rules (their verdict is part of the result) and the method's rules.
BASE = (
    Rule("few_words", lambda: F.col("_n") < 20),
    Rule("repeated_windows", lambda: 100 * n_repeat_words() > 30 * F.col("_n")),
)
EXTRA = (
    Rule("symbols", lambda: 100 * n_symbols() > 5 * F.length("_c")),
    Rule("exclamations", lambda: 100 * n_marks() > 5 * F.length("_c")),
    Rule("word_length", lambda: (F.length("_c") > 20 * F.col("_n")) | (F.length("_c") < 2 * F.col("_n"))),
    Rule("duplicate_lines", lambda: _let(lines(F.col("_text")), lambda a: 2 * (
        F.size(a) - F.size(F.array_distinct(a))) > F.size(a))),
)


def plan_cascade(df: DataFrame, rules: tuple[Rule, ...], text_col: str = "text", sample_rows: int = 2000) -> list[Rule]:
    """``rules`` by measured rejection per cost on about ``sample_rows`` rows.

    The sample (a bound documented by the parameter) is drawn by hash over
    the whole table and stored once; each rule then runs over it alone.
    Returns the given order for an empty table.
    """
    n = df.count()
    if not n:
        return list(rules)
    keep = min(1.0, sample_rows / n)
    some = df.select(F.col(text_col).alias("text")).sample(keep, seed=7)
    sample = stored(_prepared(some, F.col("text")).drop("_row"), "quality-sample")
    ranked = []
    for i, r in enumerate(rules):
        t = time.perf_counter()
        hit, of = sample.agg(F.count_if(r.reject()), F.count(F.lit(1))).first()
        ranked.append((-(hit / max(of, 1)) / (time.perf_counter() - t), i, r))
    return [r for _, _, r in sorted(ranked)]


def rejected(order: list[Rule]) -> Column:
    """True for a text that some rule refuses; later rules are not evaluated."""
    out = F.lit(False)
    for r in order:
        out = out | r.reject()
    return F.coalesce(out, F.lit(False))


def quality_features(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the columns FEATURES (own columns of these names give way);
    ``kept`` is the verdict of the ordered cascade."""
    order = plan_cascade(df, EXTRA, text_col)
    out = _prepared(df, F.col(text_col), FEATURES).select(
        "*", F.col("_n").alias("n_words"), F.length("_c").cast("long").alias("word_chars"),
        n_symbols().alias("n_symbols"), n_dup_lines(F.col("_text")).alias("n_dup_lines"),
        n_repeat_words().alias("n_repeat_words"))
    out = out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    out = out.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(~rejected(order)))
    return out.select(*unpacked(df, FEATURES), *FEATURES)


def quality_filter(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that every rule accepts, in ``df``'s columns.

    All rules, base ones included, run in one cascade, so the costly window
    count is made only for texts that the rules before it let pass.
    """
    order = plan_cascade(df, BASE + EXTRA, text_col)
    return _prepared(df, F.col(text_col)).where(~rejected(order)).select(*unpacked(df))


def op6_quality_rules(docs: DataFrame) -> DataFrame:
    return quality_features(docs.select("doc_id", "text")).drop("text")
