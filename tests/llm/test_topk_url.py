import itertools
import math
import random

import numpy as np
import pytest

from eventide.llm import topk, url_filter
from eventide.llm.queries import URL_RULES


# --------------------------------------------------------------------- top-k
def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_top(rows, k, every):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for i, q in good:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, w in good if j != i)[:k]
        out += [(i, n, j, -s) for n, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def top(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<float>, score int")
    return sorted(map(tuple, topk.top_k(df.repartition(3), **kw).collect()))


def vectors(n, seed=1, width=6):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, width)).astype(np.float32)
    v[rng.random(v.shape) < 0.4] = 0
    return [(i, [float(x) for x in row]) for i, row in enumerate(v)]


def test_matches_brute_force_with_ties(spark):
    rows = vectors(150) + [(1000 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(40)]
    assert top(spark, rows, k=5, every=50) == brute_top(rows, 5, 50)


def test_query_blocks_do_not_change_the_result(spark):
    rows = vectors(90, seed=2)
    assert top(spark, rows, k=3, every=2, block=8) == brute_top(rows, 3, 2)


def test_bad_vectors_lengths_and_few_candidates(spark):
    rows = [(0, [0.5, -0.25]), (1, None), (2, [None, 1.0]), (3, [math.nan, 1.0]), (4, [math.inf, 1.0]), (50, [1.0]),
            (5, []), (None, [1.0, 1.0]), (6, [-0.001, 0.5, 9.0])]
    assert top(spark, rows, k=5, every=50) == brute_top(rows, 5, 50)
    assert top(spark, [(0, [1.0])]) == [] and top(spark, []) == []


def test_repeated_rows_take_ranks(spark):
    rows = [(0, [1.0]), (7, [2.0]), (7, [2.0]), (9, [1.0]), (0, [1.0])]
    got = top(spark, rows, k=3, every=50)
    assert got == sorted([(0, 1, 7, 2 * 65536), (0, 2, 7, 2 * 65536), (0, 3, 9, 65536)] * 2)


def test_only_one_block_of_distinct_queries_reaches_the_driver(spark, monkeypatch):
    """A third of all rows have one id, with few and with very many vectors."""
    rng = np.random.default_rng(7)
    same = [(50, [float(x) for x in rng.integers(-3, 4, 3)]) for _ in range(30)]
    rows = vectors(120, seed=4, width=3) + same + [(100, [1.0, 2.0, 3.0])] * 40
    seen, search = [], topk._search

    def one(candidates, queries, k):
        seen.append(queries.num_rows)
        return search(candidates, queries, k)

    monkeypatch.setattr(topk, "_search", one)
    monkeypatch.setattr(topk, "REPEATS", 7)
    assert top(spark, rows, k=3, every=50, block=8) == brute_top(rows, 3, 50)
    distinct = {(i, tuple(v)) for i, v in rows if i % 50 == 0}
    assert sum(seen) == len(distinct) and len(seen) == -(-len(distinct) // 4) and max(seen) <= 12


def test_large_components_take_part(spark):
    big, huge = 9e6, 2.0 ** 24
    rows = vectors(60, seed=6, width=2) + [(100, [big, 1.0]), (101, [-big, 0.0]), (150, [0.0, 0.0, huge, -huge]),
                                           (151, [1.0, 0.0, huge, huge]), (152, [0.0, 0.0, 0.0, 2.0 ** 20])]
    assert top(spark, rows, k=70, every=50) == brute_top(rows, 70, 50)
    for bad in ([(50, [2.0 ** 30]), (1, [2.0 ** 30])], [(50, [1e30]), (1, [1.0])]):
        with pytest.raises(Exception, match="does not fit a long"):
            top(spark, bad, k=5, every=50)


def test_a_very_long_vector_costs_its_own_length(spark):
    # filled up to equal length, a slice of these rows would take 33 GB
    rows = vectors(2100, seed=4, width=3)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1).unionByName(
        spark.sql("select 1400L + 700 * id + 1 as vec_id, transform(sequence(0, 1999999), i -> "
                  "case i when 1 then 2.0D when 1999999 then 3.0D else 0.0D end) as embedding from range(2)")).coalesce(1)
    got = sorted(map(tuple, topk.top_k(df, k=3, every=700).collect()))
    short = rows + [(1401, [0.0, 2.0, 0.0]), (2101, [0.0, 2.0, 0.0])]
    assert got == brute_top(short, 3, 700)


def test_posting_lists_of_a_sliced_array():
    import pyarrow as pa
    lists = pa.array([[9], [0, 5], [], [7, 0, 2], [1, 1]], pa.list_(pa.int64()))[1:4]
    found = {t: (r.tolist(), w.tolist()) for t, (r, w) in topk.by_term(lists).items()}
    assert found == {0: ([2], [7]), 1: ([0], [5]), 2: ([2], [2])}
    part = {t: (r.tolist(), w.tolist()) for t, (r, w) in topk.by_term(lists, slice(1, 3)).items()}
    assert part == {0: ([1], [7]), 2: ([1], [2])}
    assert topk.by_term(lists[:0]) == {}


def test_selection_prefers_small_ids():
    for scores in itertools.product(range(3), repeat=5):
        ids = np.array([9, 2, 7, 4, 5])
        want = sorted(range(5), key=lambda i: (-scores[i], ids[i]))[:3]
        assert topk.best(np.array(scores), ids, 3).tolist() == want


# ----------------------------------------------------------------- URL rules
def brute_judge(rows, rules, default="allow"):
    out = []
    for page, url in rows:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:cut], rest[cut:]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
            path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
        fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules
                if h is not None and p is not None and path.startswith(p) and (host == h or host.endswith("." + h))]
        best = max(fits, default=None)
        out.append((page, host, path, best and best[3], best[2] if best else default))
    return sorted(out, key=repr)


def judged(spark, rows, rules, **kw):
    pages = spark.createDataFrame([(i, u, "x") for i, u in rows], "page_id long, url string, verdict string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    return sorted(map(tuple, url_filter.judge(pages, listed, **kw).collect()), key=repr)


URLS = ["https://a.example.net/en/1?x=/de/", "http://EXAMPLE.NET/en", "http://example.net/en/", "ftp://net/", "x://net",
        "https://badexample.com/de/", "https://example.com/de/x#y", "https://www.example.com/de", "http://org/fr/",
        "http://a.b.c.org/fr/2", "http://.org/fr/", "http://É.net/", "no scheme", "", None, "://", "a://b://net/",
        "http://user@net:80/", "http://example.net?q", "http://example.net#/en/"]


def test_fixed_rules(spark):
    rows = list(enumerate(URLS)) + [(3, URLS[3]), (None, URLS[0])]
    assert judged(spark, rows, list(URL_RULES)) == brute_judge(rows, URL_RULES)


@pytest.mark.parametrize("blocks", [1, 1 << 16])
def test_many_rules_and_a_full_filter(spark, blocks):
    rng = random.Random(3)
    hosts = [f"{a}.{b}" for a in ("x", "y.x", "z", "w.z") for b in ("com", "org")] + ["com", "org"]
    rules = [(rng.choice(hosts), rng.choice(["/", "/a", "/a/", "/a/b", "", "/é/"]), rng.choice(["block", "allow"]))
             for _ in range(60)] + [(None, "/", "block"), ("com", None, "block")]
    rows = [(i, f"http://{rng.choice(['', 'q.', 'x.'])}{rng.choice(hosts)}"
                f"{rng.choice(['', '/', '/a', '/a/b/c', '/é/1', '/ab'])}") for i in range(300)]
    assert judged(spark, rows, rules, max_blocks=blocks, default="block") == brute_judge(rows, rules, "block")


def test_no_rules_and_no_pages(spark):
    assert judged(spark, [(1, "http://a/b")], []) == [(1, "a", "/b", None, "allow")]
    assert judged(spark, [], list(URL_RULES)) == []


def test_only_ends_that_a_rule_may_have():
    assert url_filter.host_ends("a.bc.d", 9) == ["a.bc.d", "bc.d", "d"]
    assert url_filter.host_ends("a.bc.d", 4) == ["bc.d", "d"]
    assert url_filter.host_ends("a.bc.d", 3) == ["d"] and url_filter.host_ends("abc", 2) == []
    assert url_filter.host_ends(".a.", 3) == [".a.", "a.", ""] and url_filter.host_ends("", 0) == [""]
    ends = url_filter.host_ends("a." * 1_000_000 + "net", 11)
    assert sum(map(len, ends)) < 100 and ends[-1] == "net"


def test_filter_passes_every_key_and_few_others():
    rng = np.random.default_rng(1)
    keys, other = rng.integers(0, 1 << 63, 2000).astype(np.uint64), rng.integers(0, 1 << 63, 20000).astype(np.uint64)
    filt = np.zeros((64, 8), np.uint64)
    block, bit = url_filter.blocks_of(keys, 64)
    for b, bits in zip(block, bit):
        filt[b] |= np.uint64(1) << bits
    assert url_filter.may_hold(filt, keys).all() and url_filter.may_hold(filt, other).mean() < 0.05
