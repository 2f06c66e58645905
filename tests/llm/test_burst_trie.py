"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from dossierlake.llm import burst_trie as bt
from dossierlake.operators import numbering

ROW = "conv_id bigint, turn int, role string, text string, id string, depth int, n string, W string, slot string, head int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "?", 0, "?", "?", "?", 0) for r in rows], ROW).repartition(3)


def plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append((-1 if turn is None else turn, key, role, text))
    convs = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in convs.items()}
    whole = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = convs.get(c - int(c - 100 * int(c / 100)), [])[:h] + turns[h:]
    nodes = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = {p: 0 for p in nodes}, {p: 0 for p in nodes}, {p: 0 for p in nodes}
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(whole[c]) == len(p)))
        parent = min(nodes[p[:-1]]) if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(p), parent, len(members), kids[p], leaves[p], saved[p], sha))
    return out


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def check(spark, rows, limit):
    frame = bt.prefix_trie(table(spark, rows), limit)
    assert frame.columns == NAMES and [t for _, t in frame.dtypes] == ["bigint"] * 7 + ["string"]
    got = [tuple(r) for r in frame.collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


def mixed(seed, convs, long=0):
    """Shared openings, copies, and conversations that end inside others."""
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        text = [("user" if i % 2 else "assistant", r.choice("abc") * r.randrange(4)) for i in range(r.randrange(9))]
        if c % 3 == 0:
            text = [("system", "the same"), ("user", "hot"), ("assistant", "copy")] * 2
        rows += [(c, i, role, t) for i, (role, t) in enumerate(text)]
    for c in range(convs, convs + 2 * bool(long)):
        rows += [(c, i, "user", f"turn {i}") for i in range(long + c % 2)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [9, 10_000])
def test_limits_do_not_change_the_trie(spark, limit):
    check(spark, mixed(4, 120), limit)


def test_long_chains_go_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(bt, "BLOCK", 7)
    monkeypatch.setattr(bt, "PIECE", 3)
    check(spark, mixed(5, 40, long=90), 20)


def test_one_conversation_holds_nearly_all(spark):
    rows = [(7, i, "user", f"t{i}") for i in range(300)] + [(8, 0, "user", "x"), (9, 0, "user", "x")]
    check(spark, rows, 50)
    placed = numbering.in_ranges(bt.turn_rows(table(spark, rows), "conv_id", "turn", "role", "text"), ["conv", "turn", "id"])
    assert placed.where("conv = 7").select("slot").distinct().count() > 1


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no conversation"), (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""),
        (1, 5, "", "é😀"), (-101, 0, "user", "below zero"), (-150, 0, "user", "other"), (-100, 1, "user", "base"),
        (100, 0, "a", "1"), (101, 0, "a", "1"), (102, 3, "a", "1"), (102, 2, "b", "2"), (199, 0, "user", "y" * 70_000),
        (300, 0, None, "tie"), (300, 0, "tie", None), (305, 0, "u", "absent base"), (2**60, 0, "u", "far"),
    ]
    check(spark, rows, 8)


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "only") for c in range(401, 440)]
    check(spark, rows, 2)
    root = bt.prefix_trie(table(spark, rows)).where("depth = 0").collect()
    assert [(r.n_convs, r.conv_id, r.parent_conv_id) for r in root] == [(39, 401, None)]


def test_empty_table(spark):
    assert bt.prefix_trie(table(spark, [])).collect() == []
    assert bt.prefix_trie(table(spark, [(None, 1, "a", "b")])).collect() == []
