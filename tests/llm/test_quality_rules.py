import re
from collections import Counter

from helpers_llm import words
from pyspark.sql import functions as F
from rosterlane.llm import quality_rules as rules


def plain(text):
    text = text or ""
    found = words(text)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    often = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= set(range(i, i + 5))
    lines = [line for line in text.split("\n") if words(line)]
    n, dups, repeats = len(found), len(lines) - len(set(lines)), len(covered)
    chars = sum(map(len, found))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = n < 10 or 100 * repeats > 20 * n
    letterless = sum(not any(c.isalpha() for c in w) for w in found)
    bad = (
        symbols > 0.1 * n
        or chars < 2 * n
        or chars > 15 * n
        or dups > 0.4 * len(lines)
        or text.count("!") > 0.2 * n
        or len(re.findall(r"(?:^|\n)[\x20\t]*[-*•]", text)) > 0.9 * len(lines)
        or len(re.findall(r"(?:\.\.\.|…)[\x20\t]*(?:\n|$)", text)) > 0.3 * len(lines)
        or letterless > 0.4 * n
        or sum(c.isupper() for c in text) > 0.5 * chars
    )
    return (n, chars, symbols, dups, repeats, failed, not failed and not bad)


def check(df):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    texts = {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    rows = rules.quality_rules(df).collect()
    assert len(rows) == df.count()
    for r in rows:
        assert tuple(r[n] for n in names) == plain(texts[r["doc_id"]]), r


def test_equals_brute_force(documents):
    check(documents)


def test_odd_rows(spark, odd):
    check(odd.where("doc_id is not null"))
    assert rules.quality_rules(odd).count() == odd.count()
    assert rules.quality_rules(odd.where("doc_id > 100")).count() == 0
    words_ = " ".join(f"word{i}" for i in range(40))
    texts = [
        "- " + words_ + "\n\x0b\n- " + words_,
        words_ + "...",
        words_.upper(),
        "1 2 3 " * 3 + words_,
        "a b c d e a b c d e a b c d e f g h",
        words_ + " a b c d e x a b c d e",
        "same line here\n" * 3 + words_,
        "| " * 30 + words_,
        words_ + "\n" + words_,
    ]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_order_follows_rejections_per_cost(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"))
    slow = F.expr("size(array_distinct(transform(sequence(1, 3000), x -> x * doc_id))) < 0")
    order = rules.cascade_order(df, {"never": F.lit(False), "slow": slow, "half": F.col("doc_id") % 2 == 0})
    assert order[0] == "half"


def test_verdict_does_not_depend_on_the_order(documents, monkeypatch):
    first = rules.quality_rules(documents).collect()
    monkeypatch.setattr(rules, "cascade_order", lambda sample, found: sorted(found, reverse=True))
    assert sorted(map(repr, rules.quality_rules(documents).collect())) == sorted(map(repr, first))


def test_rules_stop_at_the_first_that_fails(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "doc_id long, text string")
    broken = F.raise_error(F.lit("asked")).cast("boolean")
    judged = rules.quality_cascade(df, {"all": F.lit(True)}, failed=F.col("doc_id") == 1)
    assert {r["kept"] for r in judged.collect()} == {False}
    asked = rules.quality_cascade(df, {"b": broken}, failed=F.lit(True), sample=df.where("doc_id > 5"))
    assert {r["kept"] for r in asked.collect()} == {False}


def test_no_python_on_the_way(documents):
    plan = rules.quality_rules(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
