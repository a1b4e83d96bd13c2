import resource

import numpy as np
import pytest

from eventide.llm import quality


def test_passages_cover_whole_texts():
    texts = ["ab cd", None, "", "x" * 1300, "é" * 300]
    x, owner = quality.passages(texts, 512)
    assert np.bincount(owner).tolist() == [1, 1, 1, 3, 2] and x.shape[1] == quality.N_FEATURES
    assert (x[1] == 0).all() and np.allclose(x[3][:quality.N_CLASS].sum(), 1)
    alone = np.concatenate([quality.passages([t], 512)[0] for t in texts])
    assert np.allclose(alone, x, atol=1e-6)              # neighbours in a batch do not matter


def test_word_features_by_hand():
    x, _ = quality.passages(["Go go go stop\ngo Go"], 512)
    f = x[0][-quality.N_WORD:]
    assert np.allclose(f[0], np.log1p(6)) and np.allclose(f[1], 14 / 6)
    assert np.allclose(f[3:7], [1 / 6, 1 / 6, 1 / 6, 0]) or np.allclose(f[3], 1 / 6)
    assert np.allclose(f[7], 2 / 6)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, 5)) for n in (1, 3, 2)]
    y = np.array([0.0, 1.0, 1.0])
    model = quality.GatedAttention.fit(bags, y, hidden=4, attention=3, epochs=1)
    x, first, w = np.concatenate(bags), np.array([0, 1, 4]), np.array([0.5, 1.0, 2.0])

    def loss():
        s = model._forward(x, first)[-1]
        return -(w * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum() / 3
    grads = model._gradients(x, first, y, w)
    for k, g in grads.items():
        value = model.p[k]
        for at in np.ndindex(value.shape):
            step = np.zeros_like(value)
            step[at] = 1e-6
            model.p[k] = value + step
            up = loss()
            model.p[k] = value - step
            down = loss()
            model.p[k] = value
            assert abs((up - down) / 2e-6 - g[at]) < 1e-5, (k, at)


def test_attention_finds_the_passage_that_matters():
    rng = np.random.default_rng(1)
    bags, y = [], []
    for i in range(300):
        bag = rng.normal(size=(int(rng.integers(2, 9)), 6))
        if i % 2:
            bag[rng.integers(len(bag))] += [4, -4, 0, 0, 0, 0]
        bags.append(bag)
        y.append(float(i % 2))
    model = quality.GatedAttention.fit(bags[:200], np.array(y[:200]))
    scores = [model.score(b, np.array([0]))[0] for b in bags[200:]]
    assert np.mean((np.array(scores) >= 0.5) == np.array(y[200:])) > 0.9


def slow_score(model, text, size=512):
    """One passage after the other, straight from the definitions."""
    data, p = (text or "").encode(), model.p
    words, start = [], None              # (start, end) of words of the whole text
    for i, c in enumerate(data + b" "):
        if c in b" \n":
            if start is not None:
                words.append((start, i))
            start = None
        elif start is None:
            start = i
    logits, hs = [], []
    for at in range(0, max(1, len(data)), size):
        part = data[at:at + size]
        x = np.zeros(quality.N_FEATURES)
        base = quality.N_CLASS
        for c in part:
            x[quality._CLASS[c]] += 1 / len(part)
        for c, d in zip(part, part[1:]):
            pair = [min(quality._CLASS[e], 7) for e in (c, d)]
            x[base + pair[0] * 8 + pair[1]] += 1 / len(part)
            x[base + quality.N_PAIR + (c * 31 + d * 17) % quality.N_HASH] += 1 / len(part)
        mine = [k for k, (s, _) in enumerate(words) if at <= s < at + size]
        if mine:
            f = x[base + quality.N_PAIR + quality.N_HASH:]
            sizes = [words[k][1] - words[k][0] for k in mine]
            f[0], f[1] = np.log1p(len(mine)), np.mean(sizes)
            f[2] = np.sqrt(np.mean(np.square(sizes)))
            for back in range(1, 5):
                f[2 + back] = np.mean([k >= back and data[slice(*words[k])] == data[slice(*words[k - back])]
                                       for k in mine])
            f[7] = np.mean([65 <= data[words[k][0]] <= 90 for k in mine])
        x = (x.astype(np.float32) - model.mean) / model.scale
        h = np.tanh(x @ p["W"] + p["B"])
        logits.append((np.tanh(h @ p["V"]) / (1 + np.exp(-h @ p["U"]))) @ p["w"])
        hs.append(h)
    a = np.exp(np.array(logits) - max(logits))
    return 1 / (1 + np.exp(-((a / a.sum()) @ np.array(hs) @ p["c"] + p["b"])))


def some_model():
    rng = np.random.default_rng(3)
    d = quality.N_FEATURES
    return quality.GatedAttention(0.5, rng.normal(size=d) * 0.1, 0.5 + rng.random(d), {
        "W": rng.normal(size=(d, 8)) * 0.2, "B": rng.normal(size=8), "V": rng.normal(size=(8, 4)),
        "U": rng.normal(size=(8, 4)), "w": rng.normal(size=4) * 3, "c": rng.normal(size=8), "b": np.array(0.1)})


def test_scores_against_loops(spark, docs_of):
    rng, model = np.random.default_rng(5), some_model()
    words = ["the", "The", "cat", "sat", "x1", "é", "...", "a\nb", "  "]
    texts = [" ".join(rng.choice(words, int(n))) for n in (0, 1, 5, 200, 900, 3000)] + [None, "y" * 2000]
    got = model.score_texts(texts, 512)
    assert np.allclose(got, [slow_score(model, t) for t in texts], atol=1e-6)
    rows = quality.score(docs_of(list(enumerate(texts))), model).collect()
    assert np.allclose([r.score for r in sorted(rows)], got)


def test_sections_of_a_long_text(monkeypatch):
    """A text of many sections: the same attention as over all passages at once."""
    model = some_model()
    text = " ".join(np.random.default_rng(6).choice(["alpha", "be", "Gamma"], 40_000))
    whole = model.score(*[f(quality.passages([text], 512)) for f in (lambda p: p[0], lambda p: np.array([0]))])
    monkeypatch.setattr(quality, "SECTION", 8192)
    assert abs(model.score_texts([text], 512)[0] - whole[0]) < 1e-3
    assert model.score_texts(["a", text, "b"], 512)[1] == model.score_texts([text], 512)[0]


def test_memory_of_a_long_text():
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    some_model().score_texts(["some words " * 9_000_000], 512)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000      # kB, a 100 MB text


def test_copies_of_a_labelled_document(spark, docs_of):
    """3500 copies of one document do not push the others out of the sample."""
    pairs, labels = corpus(docs_of, spark)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = docs_of([pairs[1]] * 3500 + pairs + [(3, "another text of three")])
    model = quality.train(docs, table)
    alone = quality.train(docs_of(pairs + [(3, "another text of three")]), table)
    assert model.p is not None and all(np.array_equal(model.p[k], alone.p[k]) for k in model.p)


@pytest.mark.parametrize("memory", [0, 256 << 20])
def test_batches_in_memory_or_read_again(spark, docs_of, memory):
    pairs, labels = corpus(docs_of, spark)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(docs_of(pairs), table, batch=64, memory_bytes=memory, epochs=2)
    same = quality.train(docs_of(pairs).repartition(3), table, batch=64, epochs=2)
    assert all(np.allclose(model.p[k], same.p[k]) for k in model.p)


def corpus(docs_of, spark):
    rng = np.random.default_rng(2)
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    pairs, labels = [], []
    for i in range(160):
        good = " ".join(rng.choice(words, int(rng.integers(50, 300))))
        pairs.append((i, good if i % 2 else good + " " + "SPAM!! " * 80))
        labels.append((i, i % 2, 0))
    return pairs, labels


def test_held_out_accuracy_and_edge_cases(spark, docs_of):
    pairs, labels = corpus(docs_of, spark)
    extra = [(900, None), (901, ""), (None, "alpha beta"), (902, pairs[1][1] * 50), (902, pairs[1][1] * 50)]
    table = spark.createDataFrame(labels[:100] + [(1, None, 0), (None, 1, 0), (3, 7, 0), (1, 1, 0)],
                                  "doc_id long, quality int, toxic int")
    docs = docs_of(pairs + extra)
    model = quality.train(docs, table, sample_per_class=40)
    rows = [(r.doc_id, r.score) for r in quality.score(docs, model).collect()]
    assert len(rows) == len(pairs) + len(extra) and all(0 <= s <= 1 for _, s in rows)
    held = [(s >= 0.5) == bool(i % 2) for i, s in rows if i is not None and 100 <= i < 160]
    assert np.mean(held) > 0.95
    twice = [s for i, s in rows if i == 902]
    assert len(twice) == 2 and twice[0] == twice[1] >= 0.5
    assert quality.score(docs_of([]), model).count() == 0


def test_without_labels_or_with_one(spark, docs_of):
    docs = docs_of([(1, "a"), (2, "b")])
    for labels, prior in (([], 0.5), ([(1, 1)], 1.0)):
        table = spark.createDataFrame(labels, "doc_id long, quality int")
        assert {r.score for r in quality.score(docs, quality.train(docs, table)).collect()} == {prior}
