"""The prefix trie against brute force, with units and bands small enough to be cut."""

import hashlib
import zlib

import numpy as np
import pytest

from loomfeat.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, c string, t string, `g1.x` string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def by_hand(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(w, key=lambda r: (r[0], r[1]))] for c, w in own.items()}
    built = {}
    for c, w in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(np.fmod(c, 100))
        built[c] = own.get(base, [])[:h] + w[h:]
    member = {}
    for c, w in built.items():
        for d in range(len(w) + 1):
            member.setdefault(tuple(w[:d]), []).append(c)
    kids = {}
    for k in member:
        if k:
            kids[k[:-1]] = kids.get(k[:-1], 0) + 1
    leaves, saved = dict.fromkeys(member, 0), dict.fromkeys(member, 0)
    for k, m in member.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    out = []
    for k, m in member.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))
        out.append((min(m), len(k), min(member[k[:-1]]) if k else None, len(m), kids.get(k, 0), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def table_rows():
    rng = np.random.default_rng(8)
    rows = []
    for c in [*range(0, 260), *range(-130, -90), 777, 10_000_000_123]:
        words = ["same first turn" if rng.random() < 0.6 else f"first {rng.integers(4)}"] + [f"turn {rng.integers(3)}" for _ in range(rng.integers(0, 9))]
        rows += [(c, i, "user" if i % 2 == 0 else None, w if w != "turn 2" else None) for i, w in enumerate(words)]
    rows += [(c, 3, "user", "copy") for c in range(300, 390)]
    rows += [(500, i, "a", f"long {i % 5}") for i in range(90)] + [(501, i, "a", f"long {i % 5}") for i in range(70)]
    rows += [(600, None, "a", "null first"), (600, -5, "a", "then"), (601, 1, "é", "日本"), (601, 2, "", ""), (None, 1, "a", "lost"), (602, 7, "b", "twice"), (602, 7, "b", "twice")]
    return rows


@pytest.mark.parametrize("unit, band", [(1 << 16, 1024), (40, 4), (6, 3), (1, 1)])
def test_trie_equals_brute_force(spark, monkeypatch, unit, band):
    if unit < 40:
        monkeypatch.setattr(prefix_trie, "PIECE", 8)
        monkeypatch.setattr(prefix_trie, "BROADCAST_NODES", 3)
    rows = table_rows()
    out = prefix_trie.nodes(frame(spark, rows), unit, band).collect()
    assert sorted((tuple(r) for r in out), key=str) == by_hand(rows)


def test_trie_edges(spark):
    assert prefix_trie.nodes(frame(spark, [])).count() == 0
    assert prefix_trie.nodes(frame(spark, [(None, 1, "a", "b")])).count() == 0
    one = prefix_trie.nodes(frame(spark, [(101, 0, None, None)])).collect()  # its only turn is left to an absent conversation
    assert [tuple(r) for r in one] == by_hand([(101, 0, None, None)]) and len(one) == 1


def test_node_table():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        g1, g2 = rng.integers(0, 1 << 62, (2, n))
        g2[: n // 2] = 5
        t = prefix_trie.NodeTable(g1, g2)
        assert sorted(t.number.tolist()) == list(range(n))
        assert (t.find(g1, g2) == t.number).all()
        assert (t.find(g1 + 1, g2) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.NodeTable(np.array([1, 1]), np.array([2, 2]))
