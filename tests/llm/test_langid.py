import random

import numpy as np

import corpus_pipeline as cp
from eventide.llm import langid

ALPHABETS = {"aa": "abcdefg", "bb": "hijklmn", "cc": "defghij"}


def text(rng, lang, words):
    return " ".join("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(2, 6))) for _ in range(words))


def corpus(n=60, seed=1):
    rng = random.Random(seed)
    langs = [list(ALPHABETS)[i % 3] for i in range(n)]
    return [(i, text(rng, lang, 40)) for i, lang in enumerate(langs)], langs


def test_grams_are_those_of_words_with_borders():
    letters = np.unpackbits(np.frombuffer(langid._letter_bits(), np.uint8)).astype(bool)
    texts = ["Ab, cde!", None, "x", "42", "é É\nß"]
    keys, owner = langid._grams(texts, 3, letters)
    got = ["".join(chr(int(k) >> s & 0x1FFFFF) for s in (42, 21, 0)) for k in keys]
    assert list(zip(owner.tolist(), got)) == [
        (0, " ab"), (0, "ab "), (0, " cd"), (0, "cde"), (0, "de "), (2, " x "), (4, " é "), (4, " é "), (4, " ß ")]
    assert langid._grams(["ab", None, "c"], 2, letters)[1].tolist() == [0, 0, 0, 2, 2]
    assert langid._grams([], 3, letters)[1].tolist() == []


def test_counts_match_brute_force(spark, docs_of):
    pairs, langs = corpus(9)
    got = {(r.lang, r.gram): r["count"] for r in langid.gram_counts(docs_of(pairs, langs)).collect()}
    want = {}
    for (_, t), lang in zip(pairs, langs):
        for w in t.split():
            for g in (f" {w} "[i:i + 3] for i in range(len(w))):
                key = ord(g[0]) << 42 | ord(g[1]) << 21 | ord(g[2])
                want[lang, key] = want.get((lang, key), 0) + 1
    assert got == want


def test_filter_has_no_false_negatives_and_counts_are_corrected(spark, docs_of):
    pairs, langs = corpus()
    docs = docs_of(pairs, langs)
    model = langid.train(docs, slots_per_gram=3, probes=2)     # small: many false positives
    letters = np.unpackbits(np.frombuffer(model.letters, np.uint8)).astype(bool)
    shares = {}
    for r in langid.gram_counts(docs).collect():
        shares.setdefault(r.lang, {})[r.gram] = r["count"]
    for lang, counts in shares.items():
        total = sum(counts.values())
        top = {g: max(c.get(g, 0) / sum(c.values()) for c in shares.values()) for g in counts}
        own = [g for g, c in counts.items() if c / total >= 2e-5 and c / total >= 0.1 * top[g]]
        mask = model.masks(np.array(own, np.int64).view(np.uint64))[:, 0]
        assert (mask >> np.uint64(model.languages.index(lang)) & np.uint64(1) == 1).all()
    assert (model.false_rates() > 0.04).all()
    # n-grams that no language has: what the filter claims is corrected away
    fixed = model.predict(["zzyx qqwr vvut " * 200], letters)[1][0]
    assert fixed < 0.15


def test_held_out_accuracy_and_edge_cases(spark, docs_of):
    pairs, langs = corpus(120)
    model = langid.train(docs_of(pairs[:90], langs[:90]))
    found = langid.identify(docs_of(pairs[90:], langs[90:]), model)
    assert "score" in found.columns and found.columns.count("score") == 1      # the clashing one is replaced
    rows = found.collect()
    assert all(r.lang_pred == r.lang for r in rows) and all(0 <= r.score <= 1 for r in rows)
    odd = docs_of([(1, None), (2, ""), (3, "123 !? 4"), (4, pairs[0][1] * 500), (4, pairs[0][1] * 500), (None, "ωψ")])
    got = [(r.doc_id, r.lang_pred, round(r.score, 3)) for r in langid.identify(odd, model).collect()]
    assert got[:3] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert got[3] == got[4] and got[3][1] == "aa"
    assert got[5][1] in model.languages and got[5][2] <= 0.01


def test_no_training_text(spark, docs_of):
    model = langid.train(docs_of([(1, None)]))
    assert [r.lang_pred for r in langid.identify(docs_of([(1, "abc")]), model).collect()] == ["und"]
    assert langid.identify(docs_of([]), model).count() == 0


def test_more_languages_than_a_word_has_bits(spark, docs_of):
    pairs = [(i, " ".join([chr(0x4E00 + 3 * i) + chr(0x4E01 + 3 * i) + chr(0x4E02 + 3 * i)] * 5)) for i in range(70)]
    docs = docs_of(pairs, [f"l{i:02}" for i in range(70)])
    model = langid.train(docs)
    assert model.slots.shape[1] == 2
    assert all(r.lang_pred == f"l{r.doc_id:02}" for r in langid.identify(docs, model).collect())


def large_alphabet(words, seed=5):
    """Words of one or two of 3,500 letters, Zipf."""
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, 3501)
    letters = [chr(0x4E00 + i) for i in rng.choice(3500, (words, 2), p=p / p.sum()).ravel()]
    two = rng.random(words) < 0.5
    return [letters[2 * i] + (letters[2 * i + 1] if two[i] else "") for i in range(words)]


def test_no_document_of_a_large_alphabet_is_lost(spark, docs_of):
    """Over 1 M n-grams of a language, most of them below ``min_share``."""
    words = large_alphabet(760_000)
    sizes = [400] * 1800 + [5] * 8000
    ends = np.cumsum(sizes)
    pairs = [(i, " ".join(words[e - n:e])) for i, (e, n) in enumerate(zip(ends, sizes))]
    rng = random.Random(3)
    pairs += [(100_000 + i, text(rng, "aa", 400)) for i in range(200)]
    langs = ["zz" if i < 100_000 else "aa" for i, _ in pairs]
    docs = docs_of(pairs, langs).repartition(4)
    assert langid.gram_counts(docs.filter("lang = 'zz'")).agg({"count": "sum"}).first()[0] > 1_000_000
    odd = docs_of([(-1, "ωψχ φυτ " * 9), (-2, "шщъ ыьэ")], [None, None])
    kept = {r.doc_id for r in cp.language_id(spark, docs.unionByName(odd), "").select("doc_id").collect()}
    assert kept == {i for i, _ in pairs}
    model = langid.train(docs)
    assert model.languages == ("zz", "aa") and model.orders[1] == 3 and min(model.coverage) > 0.9
    found = langid.identify(docs, model)
    assert found.filter("lang_pred <> lang").count() == 0
