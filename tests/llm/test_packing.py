import random
import time
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from eventide.llm import packing
from eventide.llm.queries import tokenizer_json

ODD = [None, "", "a", " ", "  a", "a  b", "\n\nx", "a\n", "a \n b", "x\ty", " a  b", "<|endoftext|> a <|endoftext|>b",
       "a <|endoftext|>", "it's 'quoted' 12 x,y.\nZ", "tab\t end", "trail ", "\n", "　x 　 y", "a\r\nb c\x0bd",
       "e\x85f g", "é́ \U0001F600 b", "one two\nthree\nfour five", "\x1c x"]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_str(tokenizer_json())


def ids_of(tok, text):
    return np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


@pytest.mark.parametrize("cache", [0, 5, 10_000])
def test_encoder_gives_the_tokenizers_ids(tok, cache):
    enc = packing.Encoder(tokenizer_json(), cache)
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(["ab", " ", "\n", "é", "'s", "1", "\t", ", "]) for _ in range(60))
                   for _ in range(300)]
    for _ in range(2):
        for t, ids in zip(texts, enc.encode(texts)):
            assert ids == ids_of(tok, t)[:-1].tobytes(), repr(t)


def check(rows, want, capacity):
    """Every id in exactly one piece, sequences gapless and within capacity; the padding."""
    by_doc, by_seq, padding = {}, {}, 0
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert r.length > 0 and (r.ids is None or (len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32))
    for doc, ids in want.items():
        pieces = sorted(by_doc.pop(doc), key=lambda r: r.start)
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        assert b"".join(bytes(p.ids) for p in pieces) == ids.tobytes()
        assert {p.doc_tokens for p in pieces} == {len(ids)}
    assert not by_doc
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        size = sum(p.length for p in pieces)
        assert size <= capacity
        padding += 0 if size & (size - 1) == 0 else capacity - size
    return padding


@pytest.mark.parametrize("capacity, windows, tasks", [(64, 4, 64), (2048, 16, 2), (32, 1, 1)])
def test_round_trip(spark, docs_of, tok, capacity, windows, tasks):
    rng = random.Random(capacity)
    pairs = list(enumerate(ODD)) + [(100 + i, " ".join(rng.choice(["alpha", "be", "c1", "dé\nf"])
                                                       for _ in range(rng.randint(0, 150)))) for i in range(60)]
    pairs.append((999, "long text " * 5000))
    docs = docs_of(pairs).repartition(5)
    rows = packing.pack(docs, tokenizer_json(), capacity=capacity, open_windows=windows,
                        tasks_per_group=tasks).collect()
    assert check(rows, {i: ids_of(tok, t) for i, t in pairs}, capacity) == 0


def test_nulls_repeats_and_empty(spark, docs_of, tok):
    rows = packing.pack(docs_of([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)]), tokenizer_json()).collect()
    assert sorted(((r.doc_id or 0), r.length, r.doc_tokens) for r in rows if r.length == r.doc_tokens)[-1] == (2, 1, 1)
    assert sum(r.length for r in rows) == 3 * 3 + 1
    assert packing.pack(docs_of([]), tokenizer_json()).count() == 0
    assert "ids" not in packing.pack(docs_of([]), tokenizer_json(), with_ids=False).columns


def test_windows_stay_bounded_and_best_fit():
    p = packing.Packer(10, 2)
    p.place(1, 0, 6, b"aaaa" * 6)
    p.place(2, 0, 7, b"bbbb" * 7)
    assert len(p.open) == 2
    p.place(3, 0, 3, b"cccc" * 3)            # leaves least room beside document 2
    assert [[x[0] for x in w] for w in p.done] == [[2, 3]]
    p.place(4, 0, 9, b"dddd" * 9)
    p.place(5, 0, 5, b"eeee" * 5)            # fits nowhere: tops up the fullest, the rest is placed again
    assert [[(x[0], len(x[3]) // 4) for x in w] for w in p.done][1] == [(4, 9), (5, 1)]
    assert [(x[0], x[1]) for x in p.done[2]] == [(1, 0), (5, 1)] and not p.open


def test_sequence_ids_of_many_tasks_and_groups():
    """Tasks and groups of a petabyte: no two have an id in common."""
    tasks = [packing.task_sequence(t) for t in (0, 1, 4095, 262_143, 262_144, 300_000, 2 ** 31 - 2)]
    groups = [packing.group_sequence(g) for g in (0, 1, 4095, 4096, 300_000 // 64, 2 ** 25)]
    starts = sorted([(s, 1 << 32) for s in tasks] + [(s, 1 << 20) for s in groups])
    assert all(a + n <= b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert all(-2 ** 63 <= s and s + n <= 2 ** 63 for s, n in starts)


def test_a_very_long_document_is_placed_in_linear_time():
    ids = np.arange(10_000_000, dtype="<u4").tobytes()
    packer = packing.Packer(2048, 16)
    start = time.process_time()
    packer.place(1, 0, len(ids) // 4, ids)
    assert time.process_time() - start < 2 and len(packer.done) == 10_000_000 // 2048
    assert b"".join(p[3] for w in packer.done for p in w) == ids[:4 * 2048 * len(packer.done)]


def test_documents_longer_than_a_flush(spark, docs_of, monkeypatch):
    monkeypatch.setattr(packing, "_FLUSH", 2)
    rows = packing.pack(docs_of([(1, "word " * 700), (2, "b"), (3, "more " * 300)]), tokenizer_json(), capacity=16).collect()
    for doc in (1, 2, 3):
        mine = sorted((r.start, r.length, r.doc_tokens) for r in rows if r.doc_id == doc)
        assert [s for s, _, _ in mine] == np.cumsum([0] + [n for _, n, _ in mine])[:-1].tolist()
        assert sum(n for _, n, _ in mine) == mine[0][2]
