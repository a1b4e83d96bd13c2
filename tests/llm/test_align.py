"""Two tokenizers aligned, against plain encoding and a merge of the ends."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventide.llm import align as A
from eventide.llm.queries import piece_model, tokenizer_json

DATA = "/root/testdata/sf0.001"
PARTS = [" ", "  ", "\n", "\n\n", " \n", "\t", " ", "a", "the", "of", "é", "ﬁ", "日本", "語", "<|endoftext|>", "<s>",
         "<unk>", "▁", "\x00", "1", "23", "'s", "!", "?!", "́", "😀", "x" * 70, " ", "ation", "\x1c"]


@pytest.fixture(scope="module")
def al():
    return A.Aligner(tokenizer_json(), piece_model(), 500)


def spans(ids, names):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(names[i])))
        at += len(names[i])
    return out


def tokens(al, text):
    if not text:
        return [], []
    a, b = al.a.encode(" " + text, add_special_tokens=False).ids, al.b.encode(text)
    whole = (" " + text).encode()
    if b"".join(al.bytes_a[i] for i in a) != whole or b"".join(al.bytes_b[i] for i in b) != whole:
        return [], []
    return spans(a, al.bytes_a), spans(b, al.bytes_b)


def groups(a, b):
    cuts = sorted({x[2] for x in a} & {x[2] for x in b})
    parts = [[[], []] for _ in cuts]
    for side, toks in enumerate((a, b)):
        for i, _, end in toks:
            parts[next(k for k, c in enumerate(cuts) if c >= end)][side].append(str(i))
    return ";".join(",".join(x) + "|" + ",".join(y) for x, y in parts)


def brute(al, docs):
    linked, held, out = {}, defaultdict(set), []
    for n, (i, text) in enumerate(docs):
        a, b = tokens(al, text)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        linked[n] = (i, a, b, links)
        for p in set(links):
            held[p].add(n)
    best = Counter()
    for (x, _), s in held.items():
        best[x] = max(best[x], len(s))
    for i, a, b, links in linked.values():
        g = groups(a, b)
        out.append((i, len(a), len(b), g.count(";") + 1 if g else 0, len(links),
                    sum(len(held[p]) == best[p[0]] for p in links), sum(len(held[p]) for p in links),
                    hashlib.sha256(g.encode()).hexdigest() if g else "", g))
    return sorted(out, key=str)


def test_groups_of_random_texts(al):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(0, 25))) for _ in range(4000)]
    got = A._aligned(al, texts, True)["groups"]
    assert got == [groups(*tokens(al, t)) for t in texts]


def test_shared_cuts_against_intersection():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 300):
        for share in (0.0, 0.05, 0.7, 1.0):
            ends = np.sort(rng.choice(np.arange(1, 4 * n), n - 1, replace=False)) if n > 1 else np.zeros(0, np.int64)
            a = np.append(ends, 4 * n)
            b = np.unique(np.append(np.where(rng.random(n - 1) < share, ends, ends * 2 % (4 * n - 1) + 1), 4 * n))
            got = A.shared_cuts(a, b, np.array([0]), np.array([n]))
            assert a[got].tolist() == np.intersect1d(a, b).tolist()


@pytest.mark.parametrize("frequent", [500_000, 40, 0])
def test_documents(spark, docs_of, al, frequent):
    """The pairs that are joined and those that all tasks hold give one result."""
    texts = spark.read.parquet(f"{DATA}/documents.parquet").select("text").limit(25).collect()
    docs = [(i, r.text[:900]) for i, r in enumerate(texts)]
    docs += [(100, None), (101, ""), (102, "a▁b"), (103, "same words"), (103, "same words"), (None, "same words"),
             (104, "<|endoftext|> <s>"), (105, " "), (106, "x" * 20_000), (107, "日本語" * 500)]
    got = A.align(docs_of(docs).repartition(3), tokenizer_json(), piece_model(), with_groups=True, cache_words=50,
                  frequent=frequent).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(al, docs)


def test_empty_table(spark, docs_of):
    assert A.align(docs_of([(1, "a")]).limit(0), tokenizer_json(), piece_model()).collect() == []
    assert A.align(docs_of([(1, None)]), tokenizer_json(), piece_model()).collect()[0].n_links == 0
