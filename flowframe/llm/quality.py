"""Quality rules as a short-circuit cascade, in DataFrame and SQL functions only.

Each rule is a reject condition over cheap or costly measures of a text. Their cost (seconds beyond those of an empty rule)
and selectivity (share rejected) are estimated on a random sample of at most ``SAMPLE_ROWS`` rows, then the rules are chained
by rejections per second: a text that one rule rejects never reaches the later ones. The words of a text are split once for
all rules. The order changes the time, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
#: Rows of the sample that costs and selectivities are estimated on; the rules themselves see every row.
SAMPLE_ROWS, SAMPLE_SHARE, REPEATS = 400, 0.1, 4
WINDOW = 8


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, also where the body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def words(c: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text without nulls."""
    bare = F.btrim(c, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t\n\x0b\f\r]+"))


def n_words(c: Column, w: Column) -> Column:
    return F.size(w).cast("long")


def word_chars(c: Column, w: Column) -> Column:
    return F.length(F.array_join(w, "")).cast("long")


def n_symbols(c: Column, w: Column) -> Column:
    return F.regexp_count(c, F.lit(r"[#*$%&|<>]")).cast("long")


def n_dup_lines(c: Column, w: Column) -> Column:
    lines = F.filter(F.split(c, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(c: Column, w: Column) -> Column:
    """Words inside ``WINDOW``-word windows that the text holds twice or more, the first included."""

    def covered(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(h) - WINDOW + 1)
        grams = F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, WINDOW)))
        return _let(grams, repeated)

    def repeated(g: Column) -> Column:
        order = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(_let(order, spread))

    def spread(s: Column) -> Column:
        g = lambda j: F.get(s, j)["g"]  # noqa: E731  null outside
        twice = F.filter(s, lambda x, j: x["g"].eqNullSafe(g(j - 1)) | x["g"].eqNullSafe(g(j + 1)))
        at = F.array_sort(F.transform(twice, lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last"))
        return F.aggregate(at, start, step)["n"]

    hashed = _let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.when(F.size(h) <= WINDOW, F.lit(0)).otherwise(covered(h)))
    return hashed.cast("long")


@dataclass(frozen=True)
class Rule:
    """``reject`` is true for a text to drop, given the text without nulls."""

    name: str
    measures: tuple[str, ...]
    reject: object  # (dict of measure columns) -> Column


MEASURES = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words}

#: base rules first; the method's rules widen them to symbols, word length and repeated lines
BASE = (
    Rule("few_words", ("n_words",), lambda m: m["n_words"] < 20),
    Rule("repeated_windows", ("n_words", "n_repeat_words"), lambda m: F.lit(100) * m["n_repeat_words"] > F.lit(30) * m["n_words"]),
)
RULES = BASE + (
    Rule("symbols", ("n_words", "n_symbols"), lambda m: F.lit(10) * m["n_symbols"] > F.lit(2) * m["n_words"]),
    Rule("word_length", ("n_words", "word_chars"), lambda m: (m["word_chars"] < F.lit(2) * m["n_words"]) | (m["word_chars"] > F.lit(14) * m["n_words"])),
    Rule("repeated_lines", ("n_words", "n_dup_lines"), lambda m: F.lit(20) * m["n_dup_lines"] > m["n_words"]),
)


def _condition(rule: Rule, text: Column, split: Column) -> Column:
    return rule.reject({k: MEASURES[k](text, split) for k in rule.measures})


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds a row, share rejected) of each rule on a random sample of at most ``rows`` rows; zero if it is empty.

    Each rule runs once to be compiled, then over ``REPEATS`` copies of the sample; the time of a rule that looks at nothing
    is taken off, so what remains is the rule's own work, not that of starting a job.
    """
    sample = docs.select(_text(F.col("text")).alias("text")).sample(SAMPLE_SHARE, seed=1).limit(rows)
    sample = sample.select("text", words(F.col("text")).alias("split"), F.explode(F.sequence(F.lit(1), F.lit(REPEATS)))).coalesce(1).persist()
    try:
        n = sample.count()

        def seconds(hit: Column) -> tuple[float, int]:
            one = sample.agg(F.count_if(hit))
            one.first()
            began = time.perf_counter()
            share = one.first()[0]
            return time.perf_counter() - began, share

        if not n:
            return [(rule, 0.0, 0.0) for rule in rules]
        idle, _ = seconds(F.col("text").isNull())
        timed = [(rule, *seconds(_condition(rule, F.col("text"), F.col("split")))) for rule in rules]
        return [(rule, max(0.0, took - idle) / n, hit / n) for rule, took, hit in timed]
    finally:
        sample.unpersist()


def ordered(found: list[tuple[Rule, float, float]]) -> list[Rule]:
    """Rules by rejections per second, cheapest first where none rejects."""
    return [r for r, cost, share in sorted(found, key=lambda x: (-x[2] / max(x[1], 1e-9), x[1]))]


def cascade(rules: list[Rule], text: Column) -> Column:
    """The name of the first rule that rejects the text, else null; later branches are not evaluated."""

    def chain(split: Column) -> Column:
        out = F.when(F.lit(False), F.lit(""))
        for rule in rules:
            out = out.when(_condition(rule, text, split), F.lit(rule.name))
        return out

    return _let(words(text), chain)


def passing(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns kept.

    Null and empty text have no words and are rejected; equal rows, also of one doc_id, are judged alike; a text of any
    length is measured whole.
    """
    return docs.where(cascade(ordered(estimate(docs, rules)), _text(docs["text"])).isNull())


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, every measure, base_failed and kept for each row; empty, null and repeated rows are measured alike.

    Every measure is asked for here, so each is made once a row and shared; ``kept`` is the verdict of the cascade over them,
    which stops at the first rule that rejects, in the order of the estimate.
    """
    order = ordered(estimate(docs, rules))
    text = _text(F.col("text"))
    rows = docs.select("doc_id", text.alias("text")).select("doc_id", "text", words(F.col("text")).alias("split"))
    rows = rows.select("doc_id", *[f(F.col("text"), F.col("split")).alias(k) for k, f in MEASURES.items()])
    m = {k: F.col(k) for k in MEASURES}
    failed = F.lit(False)
    for r in BASE:
        failed = failed | r.reject(m)
    first = F.when(F.lit(False), F.lit(""))
    for r in order:
        first = first.when(r.reject(m), F.lit(r.name))
    return rows.select("doc_id", *MEASURES, failed.alias("base_failed"), first.isNull().alias("kept"))
