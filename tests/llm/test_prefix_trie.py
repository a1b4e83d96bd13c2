"""The prefix trie against a brute-force trie, with every node heavy and none."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventide.llm import prefix_trie as P

DATA = "/root/testdata/sf0.001"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v, key=lambda z: z[:3])] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        path = own.get(c - c % 20, [])[:h] + own[c][h:]
        ends[tuple(path)].append(c)
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n in members:
        words = len(re.findall("[^\x20\x09-\x0d]+", n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(members[n]) - 1) * words
            leaves[n[:d]] += kids[n] == 0
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), kids[n], leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
                   for n, m in members.items()), key=str)


def trie(df, **kw):
    rebuilt, convs = P.share_openings(P.ordered_turns(df))
    return sorted((tuple(r) for r in P.prefix_trie(rebuilt, convs, **kw).select(*COLS).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "conv_id long, turn long, role string, text string, depth int, words string")


@pytest.mark.parametrize("kw", [{}, {"fragment_rows": 2}, {"fragment_rows": 30, "shard_rows": 20}])
def test_whole_table(spark, kw):
    df = spark.read.parquet(f"{DATA}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert trie(df, **kw) == brute(rows)


def test_edges_hot_and_deep(spark, chunked):
    rows = [(7, None, None, None), (7, 0, "user", ""), (7, 1, None, "a b c\td"), (None, 0, "user", "lost"),
            (41, 3, "user", "own turn"), (0, 0, "user", "x"), (0, 1, "bot", "y" * 100_000), (0, 2, "user", "z")]
    rows += [(c, t, "user", f"hot {t}") for c in range(100, 160) for t in range(3)]      # copies, a shared opening
    rows += [(c, 3, "user", f"own {c % 7}") for c in range(100, 160, 2)]
    rows += [(500, t, "bot", "deep") for t in range(70)]                                  # a long conversation
    rows += [(501, 0, "user", "twice"), (501, 0, "user", "twice")]
    rows += [(c, 0, "user", "only") for c in range(1001, 1020)]                           # base conversation absent
    want = brute(rows)
    assert any(r[1] == 0 and r[7] != P.EMPTY for r in want)       # turnless conversations end at the root
    assert trie(frame(spark, rows), fragment_rows=5, shard_rows=10) == want


def test_empty_table(spark):
    assert trie(frame(spark, [(1, 0, "a", "b")]).limit(0)) == []


def test_perfect_hash():
    rng = np.random.default_rng(3)
    high, low = (rng.integers(0, 1 << 63, 20_000).astype(np.uint64) for _ in range(2))
    high[:50] = high[0]                         # equal halves, distinct digests
    table = P.PerfectHash(high, low)
    assert sorted(table.slots(high, low)) == list(range(20_000))
    with pytest.raises(ValueError):
        table.slots(high[:1] + np.uint64(1), low[:1])
    with pytest.raises(ValueError):
        P.PerfectHash(high[[0, 0]], low[[0, 0]])


def test_ends_in_pieces(spark, monkeypatch):
    """A node at which very many end is hashed piece by piece."""
    df = spark.range(3000).selectExpr("id as conv_id", "0 as turn", "'u' as role", "'same' as text")
    monkeypatch.setattr(P, "_PIECE", 64)
    rows = [(c, 0, "u", "same") for c in range(3000)]
    assert trie(df) == brute(rows)
