"""Near duplicates against brute force."""

import itertools
import random

import numpy as np
import pytest

from dossierlake.llm import near_dup
from tests.llm.data import TEXTS, documents, prose


def weighted(text):
    words = text.split()
    if not words:
        return {}
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or [tuple(words)]
    return {g: 1 + np.log(grams.count(g)) for g in set(grams)}


def plain_similarity(x, y):
    total = 0.0
    for d in x.keys() & y.keys():
        total += 1 / sum(max(x.get(k, 0) / x[d], y.get(k, 0) / y[d]) for k in x.keys() | y.keys())
    return total


def plain_classes(rows):
    """Class of every row, by all pairs."""
    ids = sorted({i for i, t in rows if i is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {(i, t): weighted(t) for i, t in rows if i is not None and t is not None}
    for (i, s), (j, t) in itertools.combinations(sets, 2):
        x, y = sets[i, s], sets[j, t]
        if s == t or (x and y and plain_similarity(x, y) >= near_dup.SIMILARITY):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return sorted(((i, find(i) if i is not None else None) for i, _ in rows), key=repr)


def edited(text, n, seed):
    words, r = text.split(), random.Random(seed)
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def test_similarity_equals_definition():
    for seed in range(20):
        a, b = prose(seed, 40, 4), edited(prose(seed, 40, 4), 1 + seed % 4, seed)
        got = near_dup.similarity(*near_dup._weighted(a.encode()), *near_dup._weighted(b.encode()))
        assert got == pytest.approx(plain_similarity(weighted(a), weighted(b)))


def test_registers_estimate_similarity():
    text = prose(3, 400, 60)
    for edits in (2, 8, 20):
        pair = [text, edited(text, edits, edits)]
        sign = []
        for t in pair:
            data = np.frombuffer(t.encode(), np.uint8)
            of, keys, weights = near_dup.shingles(data, np.array([0, len(data)]))
            sign.append(near_dup.signatures(of, keys, weights, 1)[0])
        want = plain_similarity(*map(weighted, pair))
        assert (sign[0] == sign[1]).mean() == pytest.approx(want, abs=4 * (want * (1 - want) / 125) ** 0.5)


def test_classes_equal_brute_force(spark):
    base = [prose(s, 60, 500) for s in range(4)]
    rows = [(s, t) for s, t in enumerate(base)]
    n = 10
    for s, t in enumerate(base):
        for k in range(6):
            rows.append((n, edited(t, k % 4, 100 * s + k)))
            n += 1
    chain = prose(50, 100, 500)
    for k in range(6):  # each is near the next only
        rows.append((n, chain))
        chain = edited(chain, 1, 200 + k)
        n += 1
    rows += [(n, base[0]), (n + 1, base[0]), (n + 2, "two words"), (n + 3, "two words"), (n + 4, "two other")]
    rows += [(n + 5, ""), (n + 6, ""), (n + 7, None), (n + 8, None), (None, prose(9, 50)), (1, base[1])]
    got = sorted((tuple(r) for r in near_dup.near_duplicates(documents(spark, rows)).collect()), key=repr)
    assert got == plain_classes(rows)


def test_members_linked_past_the_head_of_a_bucket(spark):
    """b and c are near each other but not near a, which shares bands with both."""
    a = prose(70, 200, 10**6)
    b = edited(a, 11, 1)
    c = edited(b, 2, 2)
    rows = [(1, a), (2, b), (3, c)]
    got = sorted((tuple(r) for r in near_dup.near_duplicates(documents(spark, rows)).collect()), key=repr)
    assert got == plain_classes(rows)


def test_class_that_overtakes_another_between_the_searches(spark, monkeypatch):
    """The only link of two families is to a pivot whose class was the smaller one at first."""
    middle = prose(80, 200, 10**6)
    bridge = edited(middle, 4, 1)
    head = edited(bridge, 4, 2)
    texts = {1: head, 2: prose(81, 200, 10**6), 3: prose(82, 200, 10**6), 10: middle, 20: bridge}
    texts |= {21: edited(head, 4, 3), **{i: edited(middle, 4, i) for i in (22, 23, 24)}}
    buckets = {"A": [1, 20, 21], "B": [10, 20, 22, 23, 24], "C": [2, 23], "D": [3, 24]}
    bands = [(i, [n for n, b in enumerate(buckets.values()) if i in b]) for i in texts]

    def sketch(docs):
        given = spark.createDataFrame(bands, "doc bigint, bands array<bigint>")
        return docs.select("doc", "digest").join(given, "doc").select("doc", "digest", "bands")

    monkeypatch.setattr(near_dup, "sketch", sketch)
    rows = sorted(texts.items())
    got = sorted(tuple(r) for r in near_dup.near_duplicates(documents(spark, rows)).collect())
    assert got == sorted(plain_classes(rows)) == [(i, i if i in (2, 3) else 1) for i, _ in rows]


def test_odd_rows(spark):
    rows = near_dup.near_duplicates(documents(spark)).collect()
    found = sorted(((r["doc_id"], r["class_id"]) for r in rows), key=repr)
    want = {2: 1, 7: 6, 12: 11, 5: 5}
    assert found == sorted(((i, want.get(i, i) if i is not None else None) for i, _ in TEXTS), key=repr)
    assert near_dup.near_duplicates(documents(spark, [])).count() == 0


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(45)]
    edges += [(200, k) for k in range(201, 260)]
    root = {v: v for e in edges for v in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {x["doc"]: x["class"] for x in near_dup.components(spark, frame).collect()}
    alone = {v for e in edges if e[0] == e[1] for v in e} - {v for e in edges if e[0] != e[1] for v in e}
    assert got == {v: find(v) for v in root if v not in alone}


@pytest.mark.parametrize("leaders", [near_dup.LEADERS, None])
def test_large_group_around_the_limit(spark, leaders):
    """60 copies of one text, most of them near it and not near each other."""
    base = prose(90, 150, 10**6)
    rows = [(1000, base)] + [(i, edited(base, 1 + i % 5, i)) for i in range(60)]
    got = dict(tuple(r) for r in near_dup.near_duplicates(documents(spark, rows), leaders=leaders).collect())
    want = dict(plain_classes(rows))
    one = [i for i, c in want.items() if c == want[1000]]
    assert len(one) > 15
    assert all(want[i] == want[j] for i in got for j in (got[i],)), "no class joins what is apart"
    assert sum(got[i] == got[1000] for i in one) >= 0.95 * len(one)


def test_a_link_past_all_leaders_of_the_first_round(spark, monkeypatch):
    """One bucket of texts that are apart; only two of them are near, and neither leads first."""
    texts = {i: prose(300 + i, 120, 10**6) for i in range(14)}
    texts[20] = edited(texts[9], 2, 1)
    reach = [(i, [1, *range(100 * i, 100 * i + (0 if i in (9, 20) else 3))]) for i in texts]
    pairs = [(i + 30, bands[1:]) for i, bands in reach if len(bands) > 1]  # others that share the further buckets
    texts |= {i: prose(400 + i, 120, 10**6) for i, _ in pairs}

    def sketch(docs):
        given = spark.createDataFrame(reach + pairs, "doc bigint, bands array<bigint>")
        return docs.select("doc", "digest").join(given, "doc").select("doc", "digest", "bands")

    monkeypatch.setattr(near_dup, "sketch", sketch)
    got = {x["doc_id"]: x["class_id"] for x in near_dup.near_duplicates(documents(spark, sorted(texts.items())), leaders=2).collect()}
    assert got == {i: 9 if i == 20 else i for i in texts}


def all_pairs_classes(rows):
    """Class of every row, by all pairs of the operator's similarity, which is compared with its definition above."""
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: near_dup._weighted(t.encode()) for i, t in rows}
    for i, j in itertools.combinations(sets, 2):
        if near_dup.similarity(*sets[i], *sets[j]) >= near_dup.SIMILARITY:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return sorted((i, find(i)) for i in root)


def family(n, seed, words=120):
    """Texts that are like one base, most of them not near each other, and a few pairs of near ones."""
    base = prose(seed, words, 10**6)
    rows = [(i, edited(base, 4 + i % 4, 1000 * seed + i)) for i in range(n)]
    return rows + [(n + i, edited(rows[7 * i + 3][1], 1, i)) for i in range(6)]


def test_alike_texts_make_few_pairs(spark, monkeypatch):
    """Pairs grow with a group of texts that are alike and not near, not with its square; no link is lost."""
    monkeypatch.setattr(near_dup, "FEW", 4)
    made, compare = [], near_dup.compare

    def counted(pairs, texts):
        made.append(pairs.count())
        return compare(pairs, texts)

    monkeypatch.setattr(near_dup, "compare", counted)
    base = prose(500, 120, 10**6)
    rows = [(i, edited(base, 8, i)) for i in range(90)]
    rows += [(90 + i, edited(rows[7 * i + 3][1], 1, i)) for i in range(6)]
    got = sorted(tuple(r) for r in near_dup.near_duplicates(documents(spark, rows)).collect())
    assert got == all_pairs_classes(rows)
    assert sum(made) < 12 * len(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_split_groups_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(near_dup, "FEW", 3)
    rows = family(40, seed)
    twice = [(100 + i, t + " again and again " + t[:200]) for i, t in rows[:20]]  # weights above 1, other lengths
    rows += twice + [(200 + i, t.rsplit(" ", 18)[0]) for i, t in rows[:20]]
    got = sorted(tuple(r) for r in near_dup.near_duplicates(documents(spark, rows)).collect())
    assert got == all_pairs_classes(rows)
