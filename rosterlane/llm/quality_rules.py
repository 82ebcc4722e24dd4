"""Quality rules as a short-circuit cascade, in SQL functions only.

Each rule is a boolean column: does the document fail? What a rule costs and how often it rejects is
measured on a sample; the cascade then asks the rules in the order of rejections per cost and stops
at the first that fails. The order decides how much is computed, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlane.llm.common import words_of

SYMBOL = "[#*$%&|<>]"
REPEAT_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# About so many rows are read to estimate costs and rejections.
SAMPLE_ROWS = 2000


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def with_repeat_words(df: DataFrame, words: str, name: str, size: int = REPEAT_WORDS) -> DataFrame:
    """Add how many words lie in a window of ``size`` words that the text has twice or more.

    Windows are compared by a 64-bit hash within one text. Only texts that have a repeated window at
    all get their windows sorted; each word is counted once, however many windows cover it.
    """
    codes, windows = f"{name} codes", f"{name} windows"
    inner = ", ".join(f"`{codes}`[i + {j}]" for j in range(1, size))
    hashed = df.withColumn(codes, F.expr(f"transform(`{words}`, w -> xxhash64(w))")).withColumn(
        windows,
        F.expr(
            f"if(size(`{codes}`) < {size}, cast(array() as array<bigint>),"
            f" transform(slice(`{codes}`, 1, greatest(size(`{codes}`) - {size - 1}, 0)),"
            f" (c, i) -> xxhash64(c, {inner})))"
        ),
    )
    repeated = f"size(array_distinct(`{windows}`)) < size(`{windows}`)"
    # Sorted by window, equal ones are neighbours; null where the text repeats nothing.
    ordered = hashed.withColumn(
        f"{name} sorted",
        F.expr(
            f"if({repeated}, sort_array(transform(`{windows}`,"
            " (h, i) -> named_struct('h', h, 'i', i))), null)"
        ),
    )
    at = f"`{name} sorted`"
    places = ordered.withColumn(
        f"{name} places",
        F.expr(
            f"sort_array(transform(filter({at}, (s, i) -> (i > 0 and {at}[i - 1].h = s.h) or"
            f" (i < size({at}) - 1 and get({at}, i + 1).h = s.h)), s -> s.i))"
        ),
    )
    at = f"`{name} places`"
    covered = (
        f"coalesce(aggregate(transform({at}, (p, i) ->"
        f" least(coalesce(get({at}, i + 1) - p, {size}), {size})), 0L, (a, x) -> a + x), 0L)"
    )
    counted = places.withColumn(name, F.expr(covered))
    return counted.drop(codes, windows, f"{name} sorted", f"{name} places")


def standard_rules() -> dict[str, Column]:
    """Rules on layout and vocabulary over ``measured`` texts; true: the text fails."""
    text, words, chars = F.col("text"), F.col("n_words"), F.col("word_chars")
    bullets = count_of(text, r"(?:^|\n)[\x20\t]*[-*•]")
    ellipses = count_of(text, r"(?:\.\.\.|…)[\x20\t]*(?:\n|$)")
    no_letter = count_of(
        text, r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]++(?![^\x20\x09-\x0D])"
    )
    return {
        "symbols": F.col("n_symbols") > 0.1 * words,
        "word_length": (chars < 2 * words) | (chars > 15 * words),
        "same_lines": F.col("n_dup_lines") > 0.4 * F.col("n_lines"),
        "exclamations": count_of(text, "!") > 0.2 * words,
        "bullets": bullets > 0.9 * F.col("n_lines"),
        "ellipses": ellipses > 0.3 * F.col("n_lines"),
        "no_letters": no_letter > 0.4 * words,
        "capitals": count_of(text, r"\p{Lu}") > 0.5 * chars,
    }


def measured(docs: DataFrame) -> DataFrame:
    """Per document its text (null: empty) and the counts that rules use."""
    body = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    split = body.select(
        "doc_id",
        "text",
        words_of(F.col("text")).alias("words"),
        lines_with_words(F.col("text")).alias("lines"),
    )
    return with_repeat_words(split, "words", "n_repeat_words").select(
        "doc_id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - count_of(F.col("text"), r"[\x20\x09-\x0D]")).alias("word_chars"),
        count_of(F.col("text"), SYMBOL).alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        # Lines with a word that equal an earlier line.
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )


def sampled(df: DataFrame, key: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` rows, chosen by the hash of the key and so the same in every run."""
    parts = max(1, df.count() // rows)
    return df.where(F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(parts)) == 0).limit(2 * rows)


def cascade_order(sample: DataFrame, rules: Mapping[str, Column]) -> list[str]:
    """Rule names by rejections per second on the sample, the best first; ties by name.

    Every rule runs alone over the kept sample; an empty pass measures what any rule would pay.
    """

    def measured(rule: Column) -> tuple[float, float]:
        start = time.perf_counter()
        share = sample.agg(F.avg(F.coalesce(rule, F.lit(False)).cast("double"))).first()[0]
        return share or 0.0, time.perf_counter() - start

    measured(F.lit(False))
    base = measured(F.lit(False))[1]
    found = {name: measured(rule) for name, rule in rules.items()}
    return sorted(rules, key=lambda n: (-found[n][0] / max(found[n][1] - base, 1e-3), n))


def quality_cascade(
    df: DataFrame,
    rules: Mapping[str, Column],
    verdict: str = "kept",
    failed: Column | None = None,
    sample: DataFrame | None = None,
) -> DataFrame:
    """Add ``verdict``: true where no rule fails.

    ``failed`` is a decision made before; where it is true, no rule is asked. The order of the rules
    is measured on ``sample``, rows with the columns that the rules read. A rule that gives null does
    not fail. No row is dropped; an empty table stays empty.
    """
    kept = (sampled(df, "doc_id") if sample is None else sample).persist()
    try:
        order = cascade_order(kept, rules)
    finally:
        kept.unpersist()
    asked = F.when(F.lit(False) if failed is None else failed, F.lit(False))
    for name in order:
        asked = asked.when(rules[name], F.lit(False))
    return df.withColumn(verdict, asked.otherwise(F.lit(True)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Per document the counts of the base rules, whether it fails them, and the cascade's verdict.

    All rows come back, repeated ones and those without an id too. Null and empty texts have no
    words and fail. Only ``doc_id`` and ``text`` are read; other columns are left out.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    judged = quality_cascade(
        measured(docs).withColumn("base_failed", failed),
        standard_rules(),
        failed=F.col("base_failed"),
        sample=measured(sampled(docs.select("doc_id", "text"), "doc_id")),
    )
    return judged.drop("text")
