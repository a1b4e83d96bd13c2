import random

import xxhash

from eventide.llm import simhash


def brute_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits):
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    fps = sorted(set(fps))
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_fingerprint_matches_brute_force():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "one two", "a b c", "É é  x y\x0bz"]
    texts += [" ".join(rng.choice(["ab", "Cd", "é", "x1"]) for _ in range(n)) for n in (3, 4, 50, 700)]
    for t in texts:
        assert simhash.fingerprint(t, 3) == brute_fingerprint(t)


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def near_values(rng, groups, size):
    out = []
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(size):
            base ^= 1 << rng.randrange(64) if rng.random() < 0.7 else 0
            out.append(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    return out + [rng.getrandbits(64) for _ in range(50)] + [0, (1 << 64) - 1]


def components_of(spark, values, **kw):
    fps = spark.createDataFrame([(signed(v),) for v in sorted(set(values))], "fp long")
    links = simhash.near_links(fps, **kw)
    got = {r.node: r.root for r in simhash.components(links).collect()}
    return {v: got.get(signed(v), signed(v)) for v in set(values)}


def same_partition(a, b):
    pairs = {(a[v], b[v]) for v in a}
    return len(pairs) == len({x for x, _ in pairs}) == len({y for _, y in pairs})


def test_links_find_every_component(spark):
    values = near_values(random.Random(2), 6, 12)
    want = brute_components(values, 3)
    assert same_partition(components_of(spark, values, max_bits=3, segments=2), want)


def test_dense_segment_values_lose_no_link_and_add_none(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    values = near_values(rng, 3, 10) + [base ^ rng.getrandbits(5) << 40 for _ in range(40)]
    want = brute_components(values, 3)
    assert same_partition(components_of(spark, values, max_bits=3, segments=2, bucket_limit=2), want)


def test_other_distances_and_segments(spark):
    values = near_values(random.Random(4), 3, 8)
    for bits, segments in ((2, 2), (4, 2), (1, 4), (0, 2)):
        want = brute_components(values, bits)
        assert same_partition(components_of(spark, values, max_bits=bits, segments=segments), want), bits


def test_long_chain_is_one_component(spark):
    # links only between neighbours of the chain
    links = spark.createDataFrame([(i * 37 % 101, (i + 1) * 37 % 101) for i in range(100)], "a long, b long")
    got = simhash.components(links).collect()
    assert len(got) == 101 and {r.root for r in got} == {0}


def test_documents_with_nulls_copies_and_ties(spark, docs_of):
    pairs = [(5, "a b c d e"), (3, "A b c d e"), (9, None), (2, ""), (2, ""), (None, "x y z"), (8, "x y z"),
             (7, "quite another text than those"), (None, "lonely one without id here")]
    got = simhash.near_duplicates(docs_of(pairs)).collect()
    assert len(got) == len(pairs)
    by = {(r.doc_id, r.fp): r.component_id for r in got}
    assert {r.component_id for r in got if r.doc_id in (5, 3)} == {3}
    assert {r.component_id for r in got if r.doc_id in (9, 2)} == {2}
    assert {r.component_id for r in got if r.fp == signed(brute_fingerprint("x y z"))} == {8}
    assert by[(None, signed(brute_fingerprint("lonely one without id here")))] is None
    assert simhash.near_duplicates(docs_of([])).count() == 0


def test_keep_one_keeps_the_smallest_id_once(spark, docs_of):
    pairs = [(5, "a b c d e"), (3, "A b c d e"), (3, "A b c d e"), (None, "x y z"), (8, "x y z"),
             (None, "lonely one without id here"), (7, "quite another text than those")]
    docs = docs_of(pairs)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in kept.collect())) == [
        (False, 3, "A b c d e"), (False, 7, "quite another text than those"), (False, 8, "x y z"),
        (True, 0, "lonely one without id here")]
