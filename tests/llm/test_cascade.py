"""Quality rules: statistics and verdicts against plain Python, the order of the cascade, and its plan."""

import re
from collections import Counter

from lakeweave.llm import cascade, queries

from ..oracle import connect, differences
from .tables import AWKWARD, ROOT, awkward, empty, table

SPACES = "\x20\t\n\x0b\x0c\r"


def words_of(text):
    return re.findall(f"[^{SPACES}]+", text or "")


def brute(text):
    words = words_of(text)
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    stats = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated))
    n = len(words)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    capital = [w for w in words if any(c.isupper() for c in w) and not any(c.islower() for c in w)]
    rejected = (10 * stats[2] > n or stats[1] < 3 * n or stats[1] > 10 * n or 2 * stats[3] > len(lines)
                or 5 * sum(any(c.isalpha() for c in w) for w in words) < 4 * n or 2 * len(capital) > n
                or 2 * sum(c in "!?" for c in text or "") > n
                or 10 * sum(bool(re.match(f"[{SPACES}]*[-*•]", x)) for x in lines) > 9 * len(lines)
                or 10 * sum(bool(re.search(rf"(\.\.\.|…)[{SPACES}]*$", x)) for x in lines) > 3 * len(lines)
                or 50 * len(set(words)) < n)
    return (*stats, failed, not failed and not rejected)


GOOD = "\n".join(" ".join(f"wort{i * 7 + k}" for k in range(7)) for i in range(12))
CASES = [
    GOOD, GOOD.upper(), GOOD.replace(" ", "!! "), "- " + GOOD.replace("\n", "\n- "), GOOD.replace("\n", "...\n"),
    GOOD.replace(" ", " # "), " ".join(str(i) for i in range(100, 200)), " ".join("ab" * 20 + str(i) for i in range(80)),
    GOOD + "\n" + "a line of its own\n" * 13, "same words here " * 40, " ".join(f"{c}" for c in "abcdefgh" * 12),
    "x " * 49, "ein zwei drei ein zwei drei", "one two\x0bthree\x0cfour\rfive\tsix",
]


def rows_of(texts):
    return [(i, t, "en", "a") for i, t in enumerate(texts)]


def test_statistics_and_verdicts_equal_plain_python(spark):
    texts = CASES + [r[1] for r in AWKWARD]
    got = {r.id: tuple(r)[1:] for r in cascade.judged(awkward(spark, rows_of(texts))).collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute(text), text[:80] if text else text
    assert [got[i][-1] for i in range(8)] == [True] + [False] * 7


def test_documents_equal_plain_python(spark):
    docs = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_quality_rules(spark, ROOT).collect()}
    assert got == {i: brute(t) for i, t in docs.items()}


def test_order_follows_rejection_per_cost(spark):
    rules = [cascade.Rule("never", "n_words < 0"),
             cascade.Rule("slow", "size(array_distinct(transform(words, w -> sha2(cast(concat(w, text) as binary), 512)))) > 0 AND n_words >= 60"),
             cascade.Rule("quick", "n_words >= 60"), cascade.Rule("unknown", "CAST(NULL AS boolean)")]
    texts = [" ".join(f"{chr(97 + i % 26)}word{k}" for k in range(55 + i % 10)) for i in range(100)]
    docs = awkward(spark, rows_of(texts))
    found = cascade.estimates(docs, rules)
    assert found[0].rule.name == "quick" and found[0].rejected == 50
    assert all(e.rejected == 0 for e in found[1:])  # "slow" rejects nothing that "quick" leaves
    assert {r.id for r in cascade.judged(docs, rules=rules).where("kept").collect()} == {i for i in range(100) if i % 10 < 5}


def test_verdict_does_not_depend_on_the_order(spark):
    docs = cascade.measured(awkward(spark, rows_of(CASES)))
    both = docs.select(cascade.verdict(cascade.RULES).alias("a"), cascade.verdict(cascade.RULES[::-1]).alias("b")).collect()
    assert all(r.a == r.b for r in both)


def test_filtered_keeps_columns_and_rows(spark):
    docs = awkward(spark, rows_of(CASES) + AWKWARD)
    kept = cascade.filtered(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == sorted(t for t in CASES + [r[1] for r in AWKWARD] if brute(t)[-1])
    assert cascade.filtered(empty(spark)).collect() == [] and cascade.judged(empty(spark)).collect() == []


def test_plan_is_native_and_without_shuffle(spark):
    plan = cascade.judged(table(spark, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|Exchange", plan)
    assert "lang" not in plan.split("ReadSchema")[1]


def test_query_equals_its_sql(spark):
    class Query:
        run, sql = staticmethod(queries.op12_quality_rules), queries.SQL["op12_quality_rules"]

    assert differences(spark, connect(ROOT), ROOT, Query)[0] is None
