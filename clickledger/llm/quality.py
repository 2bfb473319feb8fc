"""Operator 8: quality rules as a short-circuit cascade.

The rules are a conjunction, so their order changes cost and not the verdict. A bounded
sample estimates every rule's cost (work units per document) and the share of documents
that it rejects; the rules run in order of rejections per cost, and CASE WHEN stops at
the first that fails.

Native: DataFrame expressions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.llm.common import text_or_empty

_WS = "[ \\x09-\\x0D]"
#: At most about this many documents are sampled for the order of the rules.
SAMPLE = 2000


@dataclass(frozen=True)
class Rule:
    """name; fails: SQL over _text, _words, _lines and the counts below; cost: work units a document as SQL over the counts."""

    name: str
    fails: str
    cost: str


#: Thresholds in the style of public web-corpus filters; every one needs a document of 50 words, which the base rule sees to.
RULES = (
    Rule("symbols", "n_symbols > 0.1 * n_words", "1"),
    Rule("word_length_mean", "word_chars < 3 * n_words OR word_chars > 10 * n_words", "1"),
    Rule("duplicate_lines", "n_dup_lines > 0.4 * size(_lines)", "1"),
    Rule("alphabetic_words", "size(filter(_words, w -> w rlike '\\\\p{L}')) < 0.7 * n_words", "20 * n_words"),
    Rule("shouting", "size(filter(_words, w -> w = upper(w) AND w <> lower(w))) > 0.5 * n_words", "30 * n_words"),
    Rule("emphasis", "size(filter(_words, w -> endswith(w, '!!'))) > 0.5 * n_words", "5 * n_words"),
    Rule("ellipsis_lines", "size(filter(_lines, l -> rtrim(l) rlike '(\\\\.\\\\.\\\\.|…)$')) > 0.3 * size(_lines)", "10 * size(_lines)"),
    Rule("bullet_lines", "size(filter(_lines, l -> ltrim(l) rlike '^[-*•]')) > 0.9 * size(_lines)", "10 * size(_lines)"),
)


def base_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """df plus _words, _lines (lines that hold a word) and word_chars, n_words, n_symbols, n_dup_lines, n_repeat_words."""
    words = df.withColumn("_words", F.filter(F.split(text_or_empty(text), f"{_WS}+"), lambda w: w != ""))
    lines = words.withColumn("_lines", F.filter(F.split(text_or_empty(text), "\n"), lambda x: F.regexp_like(x, F.lit("[^ \\x09-\\x0D]"))))
    n = F.size("_words")
    counted = lines.select(
        "*",
        n.cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.regexp_count(text_or_empty(text), F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 4, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))).otherwise(F.array().cast("array<bigint>")).alias("_windows"),
    )
    # Texts whose windows are all different stop at the distinct count; only the others sort.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = counted.withColumn("_sorted", F.when(repeats, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = lambda x, j: (x["h"] == F.get("_sorted", j - 1)["h"]) | (x["h"] == F.get("_sorted", j + 1)["h"])
    found = ordered.withColumn("_at", F.when(F.col("_sorted").isNotNull(), F.array_sort(F.transform(F.filter("_sorted", lambda x, j: F.coalesce(twice(x, j), F.lit(False))), lambda x: x["i"]))))
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(i - a["last"], F.lit(3))).alias("n")),
        lambda a: a["n"],
    )
    return found.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_windows", "_sorted", "_at")


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def order_rules(df: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> list[Rule]:
    """The rules by rejections per cost on a hash sample of about `sample` documents, best first; ties by name. Only documents that pass the base rule count: no other reaches them."""
    n = df.count()
    part = df.where(F.pmod(F.xxhash64(F.col(key), F.octet_length(text)), F.lit(max(1, n // sample))) == 0).select(key, text)
    passed = ~F.expr(BASE_FAILED)  # no filter: it would be pushed below the counts and repeat them
    stats = base_counts(part, text).agg(*[x for i, r in enumerate(rules) for x in (F.avg(F.when(passed, F.expr(r.cost))).alias(f"c{i}"), F.avg(F.when(passed, F.when(F.expr(r.fails), 1.0).otherwise(0.0))).alias(f"r{i}"))]).first()
    gain = {r.name: (stats[f"r{i}"] or 0.0) / (stats[f"c{i}"] or 1.0) for i, r in enumerate(rules)}
    cost = {r.name: stats[f"c{i}"] or 0.0 for i, r in enumerate(rules)}
    return sorted(rules, key=lambda r: (-gain[r.name], cost[r.name], r.name))


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """df plus word_chars, n_words, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rule, kept.

    A null or empty text has no words and fails the base rule. kept: neither base_failed nor any rule
    failed; failed_rule: the first rule of the cascade that failed. Each row is judged by its
    own text, so repeated rows get equal verdicts; an empty table gives no rows. Input columns with
    the names of results are replaced.
    """
    results = ("word_chars", "n_words", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rule", "kept")
    names = [c for c in df.columns if c.lower() not in results]
    cascade = None
    for r in order_rules(df.select(df[key].alias("_key"), df[text].alias("_text")), "_key", "_text", rules):
        cascade = F.when(F.expr(r.fails), r.name) if cascade is None else cascade.when(F.expr(r.fails), r.name)
    # The input's columns travel as one struct, so no name of theirs meets one of ours.
    counted = base_counts(df.select(F.struct(*[df[c] for c in names]).alias("_row"), df[text].alias("_text")), "_text").withColumn("base_failed", F.expr(BASE_FAILED))
    verdict = counted.withColumn("failed_rule", F.when(~F.col("base_failed"), cascade) if cascade is not None else F.lit(None).cast("string"))
    # The row number is never negative; it only keeps a caller's filter above this projection. Pushed below, the
    # filter would repeat the whole tree of counts once per use, and planning would not end.
    here = F.monotonically_increasing_id() >= 0
    final = verdict.withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull() & here)
    return final.select("_row.*", *results)
