"""Periodic runs against brute force over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from lakeweave.llm import periodic, queries

from .tables import AWKWARD, LONG, ROOT, awkward, empty, table


def brute_runs(words, least=24, exponent=3):
    n, found = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.append((i, j + q - i, q))
            i = j + 1

    def smaller(start, length, q):
        return any(all(words[k] == words[k + r] for k in range(start, start + length - r)) for r in range(1, q))

    return sorted((r for r in found if not smaller(*r)), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs))


def words_of(text):
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


def test_runs_of_numbers_equal_brute_force():
    draw = random.Random(7)
    for _ in range(400):
        least, exponent = draw.choice([(24, 3), (6, 2), (10, 3), (12, 2), (4, 2), (9, 4)])
        texts = []
        for _ in range(draw.randint(1, 4)):
            words, wanted = [], draw.randint(0, 90)
            while len(words) < wanted:
                if draw.random() < 0.5:
                    words += [draw.randint(0, 3) for _ in range(draw.randint(1, 9))] * draw.randint(1, 7)
                else:
                    words += [draw.randint(0, 2) for _ in range(draw.randint(1, 20))]
            texts.append(words)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = periodic.runs_of(np.array(sum(texts, []), np.int64), first, least, exponent)
        want = [(s + first[k], length, q) for k, t in enumerate(texts) for s, length, q in brute_runs(t, least, exponent)]
        assert [tuple(r) for r in got.tolist()] == want


def test_rows_keep_their_runs_whatever_lies_between(spark):
    texts = [("a b c " * 9).strip(), None, "", "x", " \t\n", "a b c d " * 5 + "e " + " ä 漢字\n" * 13, "solo", LONG,
             "p q r s t " * 5 + "p q x", "same " * 24, "same " * 23, "k l m n o p q r s " * 3 + "tail"]
    docs = awkward(spark, [(i, t, "en", "a") for i, t in enumerate(texts)] + [(3, "a b c " * 9, "en", "a")]).repartition(1)
    got = periodic.periodic_runs(docs).collect()
    assert len(got) == len(texts) + 1
    by_id = {r.id: r for r in got if r.id != 3}
    for i, text in enumerate(texts):
        if i in (3, 7):
            continue
        words = words_of(text)
        want = brute_runs(words)
        assert [tuple(r) for r in by_id[i].runs] == want and by_id[i].n_words == len(words)
        assert by_id[i].collapsed == collapsed(words, want)
    assert sorted(len(r.runs) for r in got if r.id == 3) == [0, 1]
    assert by_id[9].collapsed == "same" and by_id[10].runs == []
    assert by_id[7].n_words == 40_000 and by_id[7].runs == []


def test_other_bounds(spark):
    docs = awkward(spark, [(1, "a b a b a b z", "en", "a")])
    assert [tuple(r) for r in periodic.periodic_runs(docs, least=4, exponent=2).first().runs] == [(0, 6, 2)]
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, exponent=1)


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, "documents").collect()}
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, ROOT).collect()}
    assert set(got) == set(docs) and any(r.n_runs for r in got.values())
    for doc_id, text in docs.items():
        words = words_of(text)
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        elif n > 1200:
            continue  # the loop over all periods is quadratic
        runs, r = brute_runs(words), got[doc_id]
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (None if best is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


def test_awkward_rows_and_empty_tables(spark):
    rows = periodic.with_repeated_tails(awkward(spark))
    assert rows.count() == len(AWKWARD)
    assert [r.text for r in rows.where("id is null").collect()] == ["a row without an id"]
    found = periodic.digests(periodic.periodic_runs(rows, id_col="id")).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert len(found) == len(AWKWARD)
    assert all(r.n_runs == 0 and r.start is None and r.runs_sha256 == nothing for r in found if r.id in (1, 2, 3, 4))
    assert all(r.collapsed_sha256 == nothing for r in found if r.id in (1, 2, 3))
    assert periodic.digests(periodic.periodic_runs(periodic.with_repeated_tails(empty(spark)), id_col="id")).collect() == []
