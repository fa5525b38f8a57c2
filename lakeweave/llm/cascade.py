"""Quality rules as a short-circuit cascade: cheap rules that reject much come first, and a rejected text meets no further rule.

Each rule is a SQL condition that holds for a text to be rejected. Cost and selectivity of every rule are estimated on a sample:
the cost is the measured time of the rule over the sample, less that of a scan; the rejections are noted together, so that a
rule is credited only with texts that those before it let pass. Rules are ordered by rejection per cost and become one CASE
expression, which Spark leaves at the first rule that holds. The order changes the time, never the verdict.

Functions of Spark alone are used, no Python code runs on the executors, and nothing is shuffled: a text is judged where it lies.
Repeated word windows are found by sorting a text's own windows by their 64-bit hash. Null texts count as empty (and
fail the base rule); rows that repeat an id are judged one by one; whole texts are judged.
"""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .state import cut

SPACE = r"\x20\x09-\x0D"
SAMPLE_ROWS = 1_000  # expected size of the sample that costs and selectivities are estimated on
REPEATS = 4
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


class Rule(NamedTuple):
    """A text is rejected if ``rejects`` holds, a SQL condition over text, words, lines, n_lines and the columns of ``STATS``."""

    name: str
    rejects: str


#: Limits in the range of published web-text filters; each is a share of the text, so that length does not matter.
RULES = [
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("word length", "word_chars < 3 * n_words OR word_chars > 10 * n_words"),
    Rule("repeated lines", "2 * n_dup_lines > n_lines"),
    Rule("words without a letter", rf"5 * regexp_count(text, r'(?<![^{SPACE}])[^\p{{L}}{SPACE}]*+\p{{L}}') < 4 * n_words"),
    Rule("capitals", rf"2 * regexp_count(text, r'(?<![^{SPACE}])[^\p{{Lu}}\p{{Ll}}{SPACE}]*+\p{{Lu}}[^\p{{Ll}}{SPACE}]*+(?![^{SPACE}])') > n_words"),
    Rule("shouting", "2 * regexp_count(text, '[!?]') > n_words"),
    Rule("bullets", rf"10 * size(filter(lines, l -> l RLIKE r'^[{SPACE}]*[-*•]')) > 9 * n_lines"),
    Rule("open lines", rf"10 * size(filter(lines, l -> l RLIKE r'(\.\.\.|…)[{SPACE}]*$')) > 3 * n_lines"),
    Rule("few different words", "50 * size(array_distinct(words)) < n_words"),
]


def _windows() -> Column:
    """Hashes of the three-word windows. The array is bound once by an outer lambda: a plan that folds columns into one
    expression must not split the text again for every window."""
    return F.expr("""transform(array(words), w ->
        transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))[0]""")


def _repeat_words() -> Column:
    """Words that lie in a three-word window found twice or more in the text, by ``ordered``: hashes with their places, sorted."""
    return F.expr("""coalesce(transform(array(ordered), o -> size(array_distinct(flatten(transform(
        filter(o, (w, k) -> (k > 0 AND o[k - 1].h = w.h) OR (k + 1 < size(o) AND o[k + 1].h = w.h)),
        w -> array(w.i, w.i + 1, w.i + 2))))))[0], 0)""")


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, text, words, lines, n_lines, columns of ``STATS``, base_failed); ``row`` holds the columns of ``docs``."""
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({
        "words": F.array_remove(F.split("text", f"[{SPACE}]+"), ""),
        "lines": F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]"))})
    rows = rows.withColumns({"n_words": F.size("words").cast("long"), "n_lines": F.size("lines").cast("long")})
    rows = rows.withColumn("windows", F.when(F.col("n_words") >= 3, _windows()))
    several = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.withColumn("ordered", F.when(several, F.sort_array(placed)))
    rows = rows.select("row", "text", "words", "lines", "n_words", "n_lines",
                       F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                       F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                       (F.col("n_lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       _repeat_words().cast("long").alias("n_repeat_words"))
    return rows.withColumn("base_failed", F.expr(BASE))


class Estimate(NamedTuple):
    rule: Rule
    seconds: float
    rejected: int


def estimates(docs: DataFrame, rules: list[Rule] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
              seed: int = 17) -> list[Estimate]:
    """The rules in the order of the cascade, with their seconds over the sample and what each rejects of those left to it.

    About ``sample_rows`` rows are drawn; those that fail the base rule never reach a rule and are left out.
    """
    total = docs.count()
    drawn = docs.sample(min(1.0, sample_rows / max(1, total)), seed) if total > sample_rows else docs
    sample = cut(measured(drawn.select(text_col), text_col).drop("row"), "rules").where(~F.col("base_failed"))

    often = sample.withColumn("__again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))  # beyond the noise of starting a job

    def seconds(condition: str) -> float:
        best = float("inf")
        for _ in range(2):  # the first run also compiles
            began = time.perf_counter()
            often.agg(F.count_if(F.expr(condition)), F.sum(F.size("words")), F.sum(F.size("lines"))).first()
            best = min(best, time.perf_counter() - began)
        return best / REPEATS

    scan = seconds("n_words < 0")
    costs = {rule: max(seconds(rule.rejects) - scan, 1e-4) for rule in rules}
    outcomes = F.array(*[F.coalesce(F.expr(rule.rejects), F.lit(False)) for rule in rules]) if rules else F.array()
    left = [(row.o, row.n) for row in sample.groupBy(outcomes.alias("o")).agg(F.count("*").alias("n")).collect()]
    found, open_rules = [], list(range(len(rules)))
    while open_rules:
        gain = {k: sum(n for o, n in left if o[k]) for k in open_rules}
        best = max(open_rules, key=lambda k: (gain[k] / costs[rules[k]], -costs[rules[k]], -k))
        found.append(Estimate(rules[best], costs[rules[best]], gain[best]))
        left = [(o, n) for o, n in left if not o[best]]
        open_rules.remove(best)
    return found


def verdict(rules: list[Rule]) -> Column:
    """True if the base rule and all ``rules``, tried in this order, let a text pass.

    The draw never decides; it keeps Spark from pushing a filter on the verdict below the columns that it would compute again.
    """
    kept = F.when(F.col("base_failed") | (F.rand(0) < 0), False)
    for rule in rules:
        kept = kept.when(F.expr(rule.rejects), False)
    return kept.otherwise(True)


def _decided(docs: DataFrame, text_col: str, rules: list[Rule], sample_rows: int) -> DataFrame:
    order = [e.rule for e in estimates(docs, rules, text_col, sample_rows)]
    return measured(docs, text_col).withColumn("kept", verdict(order))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES,
           sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, columns of ``STATS``, base_failed, kept), one row per row of ``docs``."""
    needed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _decided(needed, "text", rules, sample_rows).select("row.id", *STATS, "base_failed", "kept")


def filtered(docs: DataFrame, text_col: str = "text", rules: list[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that the cascade keeps."""
    return _decided(docs, text_col, rules, sample_rows).where("kept").select("row.*")
