"""SimHash groups, repeated passages and decontamination against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from lakeweave.llm import components, decontamination, jaccard, membership, simhash, suffix

from .tables import AWKWARD, awkward, empty, table


def groups(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    nodes = list(range(300))
    rng.shuffle(nodes)
    edges = list(zip(nodes[:120], nodes[1:120])) + [(nodes[150], n) for n in nodes[151:200]] + [(nodes[210], nodes[210])]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = groups(nodes, edges)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: want[n] for n in linked}


def test_links_equal_all_pairs(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = {0, (1 << 64) - 1, *base}
    for b in base:
        for _ in range(12):
            fps.add(b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, 5))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).distinct().collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == want


def test_near_duplicates_equal_brute_force(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in table(spark, "documents").collect()] + [
        (5000, "same words here", "en", "a"), (5001, "SAME  words\nhere", "en", "a"), (5002, None, "en", "a"), (5003, " ", "en", "a")]
    got = {r.id: r for r in simhash.near_duplicates(awkward(spark, rows)).collect()}
    want = {i: simhash.fingerprint((t or "").encode().lower().split()) for i, t, *_ in rows}
    ids = sorted(want)
    linked = groups(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (want[a] ^ want[b]).bit_count() <= 3])
    assert {i: r.fp & (1 << 64) - 1 for i, r in got.items()} == want
    assert {i: r.component for i, r in got.items()} == linked
    assert got[5001].component == 5000 and got[5003].component == 5002 and got[5002].fp == 0


def test_near_duplicates_of_awkward_rows(spark):
    docs = awkward(spark)
    assert len(simhash.near_duplicates(docs).collect()) == len(AWKWARD)
    assert simhash.near_duplicates(empty(spark)).collect() == []
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and 9 not in {r.doc_id for r in kept.collect()}
    assert simhash.keep_first(empty(spark)).collect() == []


def brute_removal(rows, length):
    first, out = {}, {}
    texts = sorted((d, (t or "").encode()) for d, t in rows)
    for d, b in texts:
        for i in range(len(b) - length + 1):
            first.setdefault(b[i:i + length], d)
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < d:
                gone[i:i + length] = True
        left = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.setdefault(d, set()).add((len(b), int(gone.sum()), int((gone & ~np.roll(np.append(gone, False), 1)[:-1]).sum()),
                                      hashlib.sha256(left).hexdigest()))
    return out


def removed(frame):
    got = {}
    for r in frame.collect():
        got.setdefault(r.doc_id, set()).add((r.kept.n_bytes, r.kept.n_removed, r.kept.n_spans, r.kept.sha256))
    return got


@pytest.mark.parametrize("parts", [1, 7])
def test_repeated_passages_equal_brute_force(spark, parts):
    rows = [(r.doc_id, r.text, "en", "a") for r in table(spark, "documents").collect()]
    passage = "ä passage that two documents share, word for word, over more than fifty bytes. " * 2
    rows += [(900, "x" * 400, "en", "a"), (901, "y" + "x" * 49 + "z", "en", "a"), (902, "x" * 50, "en", "a"), (903, None, "en", "a"),
             (904, "before " + passage + "after", "en", "a"), (905, passage[:49], "en", "a"), (906, passage + passage, "en", "a"),
             (907, passage[:52], "en", "a"), (907, passage[:52], "en", "a"), (907, "another text " + passage[9:], "en", "a")]
    got = removed(suffix.cleaned(awkward(spark, rows).repartition(parts)))
    assert got == brute_removal([r[:2] for r in rows], 50)


def test_passages_of_awkward_rows(spark):
    docs = awkward(spark)
    out = suffix.without_repeats(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    kept = {r.doc_id for r in out.collect()}
    assert {1, 2, 3, None} <= kept and 9 not in kept
    assert suffix.without_repeats(empty(spark)).collect() == []


def test_deep_shallow_sorting():
    rng = np.random.default_rng(0)
    text = rng.integers(97, 99, 3_000, dtype=np.uint8)
    text[1500:1800] = text[100:400]
    at = np.arange(len(text) - 40)
    got = {frozenset(g.tolist()) for g in suffix.equal_windows(text, at, 40)}
    want: dict[bytes, set] = {}
    for i in at.tolist():
        want.setdefault(text[i:i + 40].tobytes(), set()).add(i)
    assert got == {frozenset(v) for v in want.values() if len(v) > 1}
    trie = suffix.BlindTrie(4)
    keys = [b"abcd", b"abce", b"abcd", b"zzzz", b"aaaa", b"abxd", b"abcd"]
    for i, key in enumerate(keys):
        trie.add(key, i)
    assert list(trie.leaves()) == [[4], [0, 2, 6], [1], [5], [3]]


def brute_leaks(docs, items, threshold=0.8):
    def shingles(words):
        return [tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))] if words else []

    def similarity(a, b):
        shared = sum(min(a.count(s), b.count(s)) for s in set(a) & set(b))
        return shared / (len(a) + len(b) - shared)

    found = {}
    for d, text in docs:
        words = (text or "").lower().split()
        for i, item in items:
            own = (item or "").lower().split()
            if own and words:
                best = max(similarity(shingles(words[s:s + len(own)]), shingles(own)) for s in range(max(1, len(words) - len(own) + 1)))
                if best >= threshold:
                    found[d, i] = best
    return found


def test_contaminated_equals_brute_force(spark):
    rng = random.Random(2)
    item = " ".join(f"token{rng.randrange(90)}" for _ in range(40))
    words = item.split()
    filler = [f"filler{rng.randrange(500)}" for _ in range(60)]
    items = [(1, item), (2, "tiny item"), (3, None), (4, ""), (5, " ".join(f"other{k}" for k in range(25))), (6, "six " * 30)]
    texts = [item, " ".join(filler + words + filler), " ".join(filler + words[:20] + ["new"] + words[21:] + filler),
             " ".join(filler + words[:20] + ["new"] + words[20:] + filler), " ".join(filler + words[:30]), " ".join(words[2:]),
             " ".join(words[20:] + words[:20]), "a tiny item in a text", "TINY\tITEM", " ".join(filler), None, "",
             " ".join(f"OTHER{k}" for k in range(25)), "six " * 40, " ".join(words[:38] + ["x", "y"])]
    docs = awkward(spark, [(k, t, "en", "a") for k, t in enumerate(texts)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.id, r.item): r.similarity for r in decontamination.contaminated(docs, bench, radius=30).collect()}
    assert got == pytest.approx(brute_leaks(list(enumerate(texts)), items))
    split = {(r.id, r.item): r.similarity for r in decontamination.contaminated(docs, bench, radius=30, block_rows=3).collect()}
    assert split == got


def test_leaks_of_awkward_rows(spark):
    docs, bench = awkward(spark), table(spark, "benchmark")
    kept = decontamination.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert decontamination.contaminated(empty(spark), bench).collect() == []
    assert decontamination.contaminated(docs, bench.where("false")).collect() == []
    whole = bench.selectExpr("item_id as doc_id", "text", "'en' as lang")
    found = decontamination.contaminated(whole, bench).collect()
    assert {(r.id, r.item) for r in found if r.id == r.item} == {(r.doc_id, r.doc_id) for r in whole.collect()}


def test_similar_documents_groups_edited_copies(spark):
    rng = random.Random(8)

    def text(n, seed):
        own = random.Random(seed)
        return [own.choice(["the", "of", "and", "to", "in", "is"]) if own.random() < 0.5 else
                f"{own.choice('bcdfgklmnprst')}{own.choice('aeiou')}{own.randrange(400)}" for _ in range(n)]

    def edited(words, edits):
        out = list(words)
        for _ in range(edits):
            out[rng.randrange(len(out))] = f"new{rng.randrange(10_000)}"
        return out

    base = [text(300, s) for s in range(12)]
    rows = [(s, " ".join(w), "en", "a") for s, w in enumerate(base)]
    rows += [(100 + s, " ".join(edited(w, 3)).upper(), "en", "a") for s, w in enumerate(base)]
    rows += [(1_000 + k, " ".join(edited(base[0], 2)), "en", "a") for k in range(150)]  # one large group of near copies
    rows += [(500, "", "en", "a"), (501, None, "en", "a"), (502, "a b", "en", "a"), (503, "A  B", "en", "a"), (504, "a c", "en", "a"),
             (505, " ".join(base[1][:150] + text(150, 77)), "en", "a")]
    got = {r.id: r.component for r in simhash.similar_documents(awkward(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert all(got[s] == s for s in range(12)) and got[505] == 505  # no two different texts meet
    assert all(got[100 + s] in (s, 100 + s) for s in range(12)) and sum(got[100 + s] == s for s in range(12)) >= 8
    assert sum(got[1_000 + k] == 0 for k in range(150)) >= 120
    assert (got[501], got[503], got[504]) == (500, 502, 504)
    assert simhash.similar_documents(empty(spark)).collect() == []


def test_spanning_links_connect_what_all_pairs_connect():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 1 + simhash.SKETCH, dtype=np.uint64)
    rows = []
    for i in range(400):
        row = centre.copy() if i % 3 else rng.integers(0, 1 << 63, 1 + simhash.SKETCH, dtype=np.uint64)
        row[0] = centre[0] ^ np.uint64(1 << int(rng.integers(0, 63)))
        for _ in range(int(rng.integers(0, 30))):
            row[1 + int(rng.integers(0, simhash.SKETCH))] ^= np.uint64(1 << int(rng.integers(0, 63)))
        rows.append(row)
    data, limit = np.array(rows), 30
    table = pa.table({"which": np.zeros(400, np.int32), "anchor": np.arange(400) // 200, "node": np.arange(400), "fp": data[:, 0].view(np.int64),
                      **{f"s{c}": data[:, 1 + c].copy().view(np.int64) for c in range(simhash.SKETCH)}})
    out = simhash._spanning(limit, 3)(table)
    got = groups(range(400), zip(out.column("a").to_pylist(), out.column("b").to_pylist()))
    near = [(i, j) for i in range(400) for j in range(i + 1, 400) if i // 200 == j // 200
            and int(np.bitwise_count(data[i, 0] ^ data[j, 0])) <= 3 and int(np.bitwise_count(data[i, 1:] ^ data[j, 1:]).sum()) <= limit]
    assert got == groups(range(400), near) and out.num_rows < 400 < len(near)


def edited_copies():
    """Texts with copies that were appended to, cut, given a header, changed in one block or in scattered words, some below 0.8."""
    rng = random.Random(21)

    def prose(n):
        return [f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{rng.randrange(300)}" for _ in range(n)]

    texts = []
    for n in (60, 90, 150, 400, 900):
        for _ in range(4):
            w = prose(n)
            block, at = n * 5 // 100, n // 3
            texts += [w, w + prose(n // 10), w + prose(n // 5), w[:n - n * 15 // 100], prose(n // 10) + w, w[:at] + prose(block) + w[at + block:],
                      [x if rng.random() > 0.01 else "new" for x in w], w + prose(n * 3 // 10), w[:n * 7 // 10]]
    hub = prose(200)  # a group whose members are linked by its centre, most of them not to each other
    texts += [hub] + [[*hub[:15 * k], *prose(10), *hub[15 * k + 10:]] for k in range(13)] + [hub + prose(18) for _ in range(30)]
    texts += [["tiny"], ["tiny", "item"], []]
    return list(enumerate(dict.fromkeys(" ".join(w) for w in texts)))


def brute_pairs(rows, similarity=0.8):
    sets = {}
    for i, text in rows:
        w = text.lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return [(a, b) for a in sets for b in sets if a < b and sets[a] and
            len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9]


def test_similar_documents_misses_no_pair(spark):
    rows = edited_copies()
    got = {r.id: r.component for r in simhash.similar_documents(awkward(spark, [(*r, "en", "a") for r in rows])).collect()}
    pairs = brute_pairs(rows)
    assert len(pairs) > 150 and [p for p in pairs if got[p[0]] != got[p[1]]] == []


@pytest.mark.parametrize("leads", [1, 8])
def test_exact_links_equal_all_pairs(spark, leads):
    rows = edited_copies()
    docs = spark.createDataFrame(rows + [(9_000 + i, t.upper()) for i, t in rows[::7]], "doc_id long, text string").repartition(3)
    nodes = {xxhash.xxh3_64_intdigest(" ".join(t.split()).encode()): i for i, t in rows}
    texts = jaccard.candidates(docs, "text", 0.8, 5)
    found = [(nodes[r.a & (1 << 64) - 1], nodes[r.b & (1 << 64) - 1]) for r in jaccard.links(texts, 0.8, leads=leads).collect()]
    pairs = brute_pairs(rows)
    assert {tuple(sorted(p)) for p in found} <= set(pairs)
    assert groups([i for i, _ in rows], found) == groups([i for i, _ in rows], pairs)


def test_texts_of_pairs_stay_and_texts_with_a_shared_passage_go(spark):
    rows = edited_copies()
    passage = " ".join(f"common{i}" for i in range(20))
    unlike = [(5_000 + i, " ".join(f"t{i}w{k}" for k in range(150)) + f" {passage} end{i}") for i in range(40)]
    twice = [(7_000 + i, t.upper()) for i, t in rows[::5]]
    texts = spark.createDataFrame(rows + unlike + twice + [(8_000, None), (8_001, "")], "doc_id long, text string").repartition(3).select("text")
    kept = {r.text for r in jaccard.with_partners(texts, 0.8, 5).collect()}
    paired = {i for p in brute_pairs(rows) for i in p}
    assert {t for i, t in rows if i in paired} <= kept and {t for i, t in twice if rows[(i - 7_000)][0] in paired} <= kept
    assert not kept & {t for _, t in unlike}


def test_similar_documents_equal_brute_force_groups(spark):
    rows = edited_copies()
    got = {r.id: r.component for r in simhash.similar_documents(awkward(spark, [(*r, "en", "a") for r in rows])).collect()}
    assert got == groups([i for i, _ in rows], brute_pairs(rows))  # no link below 0.8 either


def test_pairs_to_verify_grow_with_the_texts_of_a_hot_passage(spark, monkeypatch):
    """A passage of 40 words in texts with tails of their own, and a few true pairs among them."""
    own, counts = jaccard.verified, {}
    for n in (200, 400):
        asked = []
        monkeypatch.setattr(jaccard, "verified", lambda pairs, *rest: asked.append(pairs.count()) or own(pairs, *rest))
        passage = " ".join(f"common{i}" for i in range(40))
        rows = [(i, f"{passage} " + " ".join(f"t{i}w{k}" for k in range(20 + i % 37)), "en", "a") for i in range(n)]
        rows += [(n + i, rows[i][1].replace("w3 ", "changed "), "en", "a") for i in range(0, n, 10)]
        texts = jaccard.candidates(awkward(spark, rows), "text", 0.8, 5)
        found = {tuple(sorted((r.a, r.b))) for r in jaccard.links(texts, 0.8).collect()}
        counts[n] = sum(asked)
        assert len(found) >= n // 10 * 0.8
    assert counts[400] <= 2.5 * counts[200] and counts[400] <= 16 * 400


def test_rows_are_told_apart_by_their_keys(spark, monkeypatch):
    """No row with a key is missed, also nulls and repeated rows; few others come along until the bitmap is at its bound."""
    rows = spark.range(20_000).selectExpr("id - 500 as n", "if(id % 7 = 0, null, concat('k', id % 5000)) as s", "'x' as __part").repartition(5)
    rows = rows.union(rows.limit(300)).cache()
    keys = rows.where("abs(xxhash64(n)) % 40 = 0").select("n", "s").distinct()
    have = rows.join(keys, rows["n"].eqNullSafe(keys["n"]) & rows["s"].eqNullSafe(keys["s"]), "left_semi").count()
    for bound, most in ((membership.BITS, 1.1), (membership.PART, 40)):
        monkeypatch.setattr(membership, "BITS", bound)
        may, cannot = membership.told_apart(rows, [rows["n"], rows["s"]], keys)
        assert may.columns == rows.columns and sorted(may.union(cannot).collect(), key=str) == sorted(rows.collect(), key=str)
        same = cannot["n"].eqNullSafe(keys["n"]) & cannot["s"].eqNullSafe(keys["s"])
        assert cannot.join(keys, same, "left_semi").count() == 0
        assert have <= may.count() < most * have + 700
    may, cannot = membership.told_apart(rows, [rows["n"], rows["s"]], keys.limit(0))
    assert may.count() == 0 and cannot.count() == rows.count()


def test_texts_without_findings_are_not_shuffled(spark, tmp_path):
    """Only texts that lose something, or may, go through an exchange; the others are read and written in one stage."""
    lines = [" ".join(f"t{i}w{j}" for j in range(400)) for i in range(200)]
    rows = [(i, text, "en", "a") for i, text in enumerate(lines)] + [(1000, lines[3], "en", "a"), (1001, lines[5][:900], "en", "a")]
    awkward(spark, rows).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stage, gone in ((simhash.keep_first, {1000}), (suffix.without_repeats, {1000, 1001})):
            out = stage(docs)
            plan = out._jdf.queryExecution().sparkPlan().toString()
            assert "Union" in plan and "LeftSemi" not in plan
            assert {r.doc_id for r in out.collect()} == {r[0] for r in rows} - gone
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
