"""N-gram scores and mixing against brute force."""

import math
from collections import Counter

import pytest

from lakeweave.llm import lm_scoring, mixing

from .tables import AWKWARD, awkward, empty


def brute_scores(texts, order, alpha=0.4):
    docs = [(t or "").split() for t in texts]

    def grams(words, n):
        return Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))

    every = [sum((grams(d, n) for d in docs), Counter()) for n in range(1, order + 1)]
    out = []
    for words in docs:
        own = [grams(words, n) for n in range(1, order + 1)]
        left = max(1, sum(map(len, docs)) - len(words))

        def score(gram):
            n = len(gram)
            count = every[n - 1][gram] - own[n - 1][gram]
            if n == 1:
                return math.log(max(count, alpha) / left)
            if count > 0:
                return math.log(count / (every[n - 2][gram[:-1]] - own[n - 2][gram[:-1]]))
            return math.log(alpha) + score(gram[1:])

        out.append(sum(score(tuple(words[max(0, i - order + 1):i + 1])) for i in range(len(words))))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, order):
    rows = [(i, t, "en", "a") for i, t in enumerate(
        ["a b c a b d", "a b c", "b c a b", "", None, "x y z x y", "a b c a b d", "q", "the a b c the a b"] * 2)]
    got = {r.id: r for r in lm_scoring.scores(awkward(spark, rows), order=order).collect()}
    for (i, text, *_), want in zip(rows, brute_scores([r[1] for r in rows], order)):
        assert got[i].n_words == len((text or "").split())
        assert got[i].log_score == pytest.approx(want, abs=1e-9)


def test_scores_of_awkward_rows(spark):
    got = lm_scoring.scores(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    assert all(r.log_score == 0 and r.mean_log_score == 0 for r in got if r.id in (1, 2, 3))
    assert lm_scoring.scores(empty(spark)).collect() == []


def brute_targets(sizes, budget=1.5, weights=(3, 1, 2), most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = budget * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        shared = sum(weight[s] for s in names if s not in full)
        share = {s: most * sizes[s] if s in full else rest * weight[s] / shared for s in names}
        over = {s for s in names if s not in full and share[s] > most * sizes[s]}
        if not over:
            return share
        full |= over


def mixed_rows():
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 40)), "en", ["a", "b", "c", "é", "Z", None][min(5, i * i % 13 % 7)]) for i in range(600)]
    return rows + [(1000 + i, "w " * 10, "en", "hot") for i in range(900)] + [(2000, "w " * 5000, "en", "c"), (2001, None, "en", "a")]


def test_mix_meets_its_targets(spark):
    rows = mixed_rows()
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    want = brute_targets(sizes)
    got = mixing.mix(awkward(spark, rows), bucket_rows=50, fan_in=3).collect()
    assert len(got) == len(rows)
    longest = {s: max(len((t or "").split()) for _, t, _, x in rows if x == s) for s in sizes}
    for source, target in want.items():
        own = [r for r in got if r.source == source]
        assert all(r.target == pytest.approx(target) and r.source_size == sizes[source] for r in own)
        assert abs(sum(r.taken for r in own) - target) <= longest[source]
    assert all(r.taken == r.copies * r.size and r.taken <= 2 * r.size for r in got)
    again = mixing.mix(awkward(spark, rows).repartition(5), bucket_rows=50, fan_in=3).collect()
    assert sorted((r.id, r.taken) for r in got) == sorted((r.id, r.taken) for r in again)


def test_expanded_mix_has_every_copy(spark):
    docs = awkward(spark, mixed_rows() + [r for r in AWKWARD if r[0] is not None])
    taken = sum(r.copies for r in mixing.mix(docs).collect())
    out = mixing.expand(docs)
    assert out.columns == [*docs.columns, "copy"]
    assert out.count() == taken
    assert mixing.expand(empty(spark)).collect() == [] and mixing.mix(empty(spark)).collect() == []
