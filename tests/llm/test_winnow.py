import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import winnow

from .helpers import WORD, lower


def brute(docs, items, span=10):
    windows = {}
    for item, text in items:
        words = re.findall(WORD, lower(text))
        n = min(span, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows.setdefault(tuple(words[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        words, hit, found = re.findall(WORD, lower(text)), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(words[i:i + n])]
        out.append((doc, len(words), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def ordered(rows):
    return sorted(rows, key=repr)


def run(spark, docs_of, docs, items, **kw):
    table = spark.createDataFrame(items, "item_id long, text string")
    got = winnow.contamination(docs_of(docs), table, **kw)
    return ordered((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect())


@given(st.lists(st.integers(0, 3), min_size=0, max_size=60), st.integers(1, 7))
@settings(max_examples=200, deadline=None)
def test_winnowing_picks_the_rightmost_minimum_of_every_window(values, window):
    grams = np.array(values, np.uint64)
    want = {max(j for j in range(i, i + window) if values[j] == min(values[i:i + window]))
            for i in range(len(values) - window + 1)}
    assert set(winnow.winnow(grams, window).tolist()) == want


def test_words_of_long_texts_do_not_depend_on_sections():
    text = "Word-é1 xüy " * 200_000
    assert re.findall(WORD, lower(text[:12])) == ["word", "é1", "xüy"]
    got = winnow.word_hashes(text)
    assert len(got) == 200_000 * 3
    assert (got.reshape(-1, 3) == got[:3]).all()


def test_matches_brute_force(spark, docs_of):
    rng = np.random.default_rng(5)
    words = ["alpha", "be", "Ça", "d1", "e"]

    def text(n):
        return " ".join(rng.choice(words, n))
    items = [(i, text(int(rng.integers(8, 40)))) for i in range(12)]
    items += [(20, "one two three"), (21, "unique"), (22, ""), (23, None), (None, text(15)), (0, items[0][1])]
    docs = [(i, text(int(rng.integers(0, 30))) + " " + items[i % 12][1][3:] + " " + text(5)) for i in range(40)]
    docs += [(100, "x one TWO three, y unique"), (101, None), (102, ""), (103, items[3][1]), (103, items[3][1]),
             (104, "-- !!"), (None, items[4][1]), (105, "word " * 3000 + items[5][1])]
    assert run(spark, docs_of, docs, items) == ordered(brute(docs, items))


def test_saturated_filter_and_other_lengths_change_nothing(spark, docs_of):
    rng = np.random.default_rng(6)
    items = [(i, " ".join(rng.choice(list("abcdef"), 25))) for i in range(8)]
    docs = [(i, " ".join(rng.choice(list("abcdef"), 40)) + " " + items[i % 8][1]) for i in range(16)]
    want = ordered(brute(docs, items))
    assert run(spark, docs_of, docs, items, max_filter_bits=64) == want
    assert run(spark, docs_of, docs, items, gram=2) == want
    assert run(spark, docs_of, docs, items, gram=10) == want
    assert run(spark, docs_of, docs, items, span=6, gram=3) == ordered(brute(docs, items, 6))


def test_empty_tables(spark, docs_of):
    assert run(spark, docs_of, [], [(1, "a b c")]) == []
    assert run(spark, docs_of, [(1, "a b c")], []) == [(1, 3, 0, [])]


def test_drop_keeps_clean_rows_whole(spark, docs_of):
    passage = "the quick brown fox jumps over the lazy dog again today"
    docs = docs_of([(1, "clean text"), (2, "x " + passage), (None, passage), (None, None), (3, "clean text")])
    kept = winnow.drop_contaminated(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert ordered((r.doc_id, r.text) for r in kept.collect()) == ordered(
        [(1, "clean text"), (None, None), (3, "clean text")])
