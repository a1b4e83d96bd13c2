"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

A text with one space before it is cut into tokens by a byte-level BPE (A) and
by a sentence-piece model (B).  Where a token of A and one of B end at the same
byte, the text has a shared cut.  An interval looks for a shared cut near its
middle: A's token ends around the middle are tried, nearest first, each by
bisection among B's ends; at the first that B has too the interval is divided
and both halves go on.  An interval without any is a leaf, one group of tokens.
All open intervals of a batch take each step together (``shared_cuts``).

A token of A and one of B are linked if their bytes overlap.  A pair of ids
counts in how many documents of the corpus it is linked; a link is *best* if
its count is the highest that its A id has.

Plan.  (1) One Arrow map cuts, groups and links every text; each document's
different id pairs with their numbers of links are written to the shared
folder, once.  (2) Pairs are counted within tasks and combined.  (3) The
``frequent`` most frequent pairs at most (two longs and a flag each) go to all
tasks, which add up their counts without a shuffle; pairs below that frequency
are joined, whatever their number, so a pair that nearly every document holds
is never a hot join key and nothing is left out.

Words.  No token stretches over a single space or line feed between other
characters: A's pattern cuts there, and no piece of B holds a space behind
another character or a line feed (checked on the vocabulary, else texts stay
whole).  So texts are encoded by words, and the ids of a word are remembered
per Python worker (``cache_words`` at most).  Memory grows with the longest
stretch without such a place.

Defined results: null and empty texts, and texts whose joined token bytes are
not the text (U+2581 is read as a space), have no tokens: zeros and ''.
Special tokens' strings inside texts are plain text.  Null ids stay null;
repeated rows are documents of their own, in the counts too; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import SECTION, reliable, shared_path, slices_of, worker_cache

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_SPACE = re.compile(r"\s")
_RUNS = ("  ", " \n", "\n ", "\n\n")
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_KEEP = 64          # longer words are not remembered


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 bytes are themselves, the others follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers and the ids of words met before."""

    def __init__(self, tokenizer_json: str, piece_model: bytes, cache_words: int):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(tokenizer_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=piece_model)
        table = byte_alphabet()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(table[c] for c in names[i]) if i in names and all(c in table for c in names[i])
                        else names.get(i, "").encode() for i in range(max(names) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.len_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.len_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.by_words = all("▁" not in p.lstrip("▁") and "\n" not in p for p in pieces)
        self.bits = max(len(self.bytes_a), len(self.bytes_b)).bit_length()
        # a token's decimal id and the mark behind it, by 4 * id + mark
        most = max(len(self.bytes_a), len(self.bytes_b))
        self.names = np.array([b"%d%s" % (i, m) for i in range(most) for m in (b",", b"|", b";", b"")])
        self.limit = cache_words
        self.ids_a: dict[str, bytes] = {}
        self.ids_b: dict[str, bytes] = {}
        self.bad: set[str] = set()

    def words(self, text: str) -> list[str]:
        """Parts of the text: a word stands for itself after a space, one
        that begins with a line feed or a space has nothing before it."""
        if not self.by_words:
            return [" " + text]
        if text[0] not in " \n" and text[-1] not in " \n" and not any(r in text for r in _RUNS) \
                and not any(c in text for c in _OTHER_SPACE):
            return text.replace("\n", " \n").split(" ")
        return [w if _SPACE.search(w, 1) or w[0] == "\n" else w[1:] for w in _CUT.split(" " + text)]

    def _learn(self, words: list[str]) -> None:
        plain = [w if w[0] in " \n" else " " + w for w in words]
        got_a = self._encode_a(plain)
        got_b = self.b.encode([w[1:] if w[0] == " " else w for w in plain], num_threads=1)
        for w, text, ids, b in zip(words, plain, got_a, got_b):
            if text[0] == "\n":         # without the space that B has put before it
                b = b[1:]
            whole = text.encode()
            if b"".join([self.bytes_a[i] for i in ids]) != whole \
                    or b"".join([self.bytes_b[i] for i in b]) != whole:
                self.bad.add(w)
            self.ids_a[w] = np.array(ids, "<u4").tobytes()
            self.ids_b[w] = np.array(b, "<u4").tobytes()

    def _encode_a(self, plain: list[str]) -> list[list[int]]:
        """Words without white space inside are encoded many at a time, one to
        a line: a line feed before a space or a word is a token of its own."""
        out: list = [None] * len(plain)
        line = self.a.encode("\n", add_special_tokens=False).ids
        for mark in " \n":
            easy = [i for i, w in enumerate(plain) if w[0] == mark and not _SPACE.search(w, 1) and len(w) > 1]
            for at in range(0, len(easy), 4096):
                part = easy[at:at + 4096]
                text = "\n".join(plain[i] for i in part) if mark == " " else "".join(plain[i] for i in part)
                ids = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
                cuts = [k for k, t in enumerate(ids) if t == line[0]]
                if len(line) != 1 or len(cuts) != len(part) - (mark == " "):
                    continue
                if mark == " ":
                    for i, lo, hi in zip(part, [0, *(c + 1 for c in cuts)], [*cuts, len(ids)]):
                        out[i] = ids[lo:hi]
                else:
                    for i, lo, hi in zip(part, cuts, [*cuts[1:], len(ids)]):
                        out[i] = ids[lo:hi]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, self.a.encode_batch_fast([plain[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def encode(self, texts: list) -> list[tuple[bytes, bytes]]:
        """(ids of A, ids of B) of each text, both empty where it has no tokens."""
        cut = [self.words(t) if t else [] for t in texts]
        new = set().union(*cut).difference(self.ids_a)
        self._learn(list(new))
        a, b, out = self.ids_a.__getitem__, self.ids_b.__getitem__, []
        for words in cut:
            if self.bad and not self.bad.isdisjoint(words):
                words = []
            out.append((b"".join(map(a, words)), b"".join(map(b, words))))
        full = len(self.ids_a) > self.limit
        for w in new:
            if full or len(w) > _KEEP:
                del self.ids_a[w], self.ids_b[w]
                self.bad.discard(w)
        return out


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Divide and conquer.  ``lo`` and ``hi`` are intervals of A's tokens whose
    outer ends B shares; returns the last token of each leaf, ascending.

    A round tries, for every open interval, the next ring of token ends around
    its middle; rings double, so that an interval without a shared cut is a
    leaf after few rounds, and the hit nearest to the middle divides."""
    leaves = []
    ring = np.zeros(len(lo), np.int64)          # distances below this are tried
    while len(lo):
        inner = hi - 1 - lo                     # ends inside the interval
        mid = lo + (inner - 1) // 2
        reach = np.maximum(mid - lo, hi - 2 - mid) + 1
        done = ring >= np.where(inner > 0, reach, 0)
        leaves.append(hi[done] - 1)
        lo, hi, mid, ring, reach = (x[~done] for x in (lo, hi, mid, ring, reach))
        if not len(lo):
            break
        upto = np.minimum(np.maximum(2 * ring, 1), reach)
        tries = 2 * (upto - ring)               # both sides of the middle
        owner = np.repeat(np.arange(len(lo)), tries)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(tries) - tries, tries)
        away = ring[owner] + k // 2
        spot = mid[owner] + np.where(k % 2, away, -away)
        ok = (spot >= lo[owner]) & (spot < hi[owner] - 1)
        owner, spot, away = owner[ok], spot[ok], away[ok]
        at = np.searchsorted(ends_b, ends_a[spot])
        hit = ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a[spot]
        first = np.unique(owner[hit], return_index=True)    # tries are ordered by distance
        cut = np.full(len(lo), -1)
        cut[first[0]] = spot[hit][first[1]]
        split = cut >= 0
        lo, hi, ring = (np.concatenate([lo[split], cut[split] + 1, lo[~split]]),
                        np.concatenate([cut[split] + 1, hi[split], hi[~split]]),
                        np.concatenate([np.zeros(2 * split.sum(), np.int64), upto[~split]]))
    return np.sort(np.concatenate(leaves)) if leaves else np.zeros(0, np.int64)


def _aligned(al: Aligner, texts: list, with_groups: bool) -> dict[str, list]:
    """Columns of a slice of texts."""
    got = al.encode(texts)
    a = np.frombuffer(b"".join(x for x, _ in got), "<u4").astype(np.int64)
    b = np.frombuffer(b"".join(x for _, x in got), "<u4").astype(np.int64)
    n_a = np.array([len(x) // 4 for x, _ in got], np.int64)
    n_b = np.array([len(x) // 4 for _, x in got], np.int64)
    ends_a, ends_b = np.cumsum(al.len_a[a]), np.cumsum(al.len_b[b])
    to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
    full = n_a > 0
    last_a = shared_cuts(ends_a, ends_b, (to_a - n_a)[full], to_a[full])
    last_b = np.searchsorted(ends_b, ends_a[last_a])
    n_groups = np.diff(np.searchsorted(last_a, to_a), prepend=0)
    # every overlap of two tokens ends where one of them does
    inner = np.ones(len(b), bool)
    inner[last_b] = False
    ends = np.sort(np.concatenate([ends_a, ends_b[inner]]), kind="stable")
    link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    doc = np.searchsorted(to_a, link_a, side="right")
    w = al.bits
    keys = np.sort((doc << 2 * w) | (a[link_a] << w) | b[link_b])
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    times = np.diff(new, append=len(keys))
    keys = keys[new]
    to_pairs = np.searchsorted(keys >> 2 * w, np.arange(len(got)), side="right")
    mask = (1 << w) - 1
    # A's and B's tokens in the order of groups, with the mark behind each
    group_a = np.searchsorted(last_a, np.arange(len(a)))
    group_b = np.searchsorted(last_b, np.arange(len(b)))
    place_a = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group_a]
    place_b = np.arange(len(b)) + (last_a + 1)[group_b]
    mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    mark_a[last_a], mark_b[last_b] = 1, 2
    mark_b[(to_b - 1)[full]] = 3
    codes = np.empty(len(a) + len(b), np.int64)
    codes[place_a], codes[place_b] = 4 * a + mark_a, 4 * b + mark_b
    out: dict[str, list] = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups,
                            "n_links": n_a + n_b - n_groups, "groups_sha256": [], "pairs": [], "groups": []}
    at = start = 0
    for i in range(len(got)):
        end = int(to_a[i] + to_b[i])
        text = al.names[codes[start:end]].tobytes().replace(b"\0", b"")
        out["groups_sha256"].append(hashlib.sha256(text).hexdigest() if text else "")
        out["groups"].append(text.decode() if with_groups else None)
        to = int(to_pairs[i])
        k = keys[at:to]
        out["pairs"].append(b"".join(np.asarray(x, "<u4").tobytes() for x in
                                     ((k >> w) & mask, k & mask, times[at:to])))
        at, start = to, end
    return out


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_STORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, " \
          "pairs binary, groups string"


def _pairs_of(column: pa.Array):
    """(pair, links, rows' ends) of a batch: pair = A's id << 32 | B's id."""
    parts = [np.frombuffer(x, "<u4").reshape(3, -1) for x in column.to_pylist()]
    ends = np.cumsum([p.shape[1] for p in parts], dtype=np.int64)
    flat = np.concatenate(parts, axis=1).astype(np.int64) if parts else np.zeros((3, 0), np.int64)
    return flat[0] << 32 | flat[1], flat[2], ends


def _count(batches):
    """(pair, documents) of a task, given out when they are many."""
    kept, size = [], 0

    def merged():
        pair, n = (np.concatenate(x) for x in zip(*kept))
        order = np.argsort(pair, kind="stable")
        pair, n = pair[order], n[order]
        new = np.flatnonzero(np.diff(pair, prepend=-1))
        return pair[new], np.add.reduceat(n, new) if len(new) else n

    for batch in batches:
        pair, _, _ = _pairs_of(batch.column("pairs"))
        kept.append((pair, np.ones(len(pair), np.int64)))
        size += len(pair)
        if size > 2_000_000:
            kept = [merged()]
            size = len(kept[0][0])
            if size > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept[0]], ["pair", "n"])
                kept, size = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], ["pair", "n"])


def _frequent(counts: DataFrame, most: int):
    """The lowest count that at most ``most`` pairs reach."""
    level = F.floor(8 * F.log2("n")).cast("int")
    total, least = 0, None
    rows = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n")).collect()
    for r in sorted(rows, key=lambda r: -r["level"]):       # 512 levels at most
        total += r["k"]
        if total > most:
            break
        least = r["n"]
    return least, total > most


def align(docs: DataFrame, tokenizer_json: str, piece_model: bytes, *, id_col: str = "doc_id",
          text_col: str = "text", with_groups: bool = False, cache_words: int = 300_000,
          frequent: int = 500_000) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256 and, ``with_groups``, the groups as text
    (``a1,a2|b1;a3|b2,b3``).  ``tokenizer_json`` is the text of a byte-level
    BPE tokenizer file, ``piece_model`` the bytes of a sentence-piece model."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    key = (zlib.crc32(tokenizer_json.encode()), zlib.crc32(piece_model), cache_words)

    def cut(batches):
        al = worker_cache(("align", *key), lambda: Aligner(tokenizer_json, piece_model, cache_words))
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for lo, hi in slices_of(texts, SECTION):
                cols = _aligned(al, texts[lo:hi].to_pylist(), with_groups)
                yield pa.RecordBatch.from_arrays(
                    [ids[lo:hi], *(pa.array(cols[c], pa.int64()) for c in _COUNTS),
                     pa.array(cols["groups_sha256"], pa.string()), pa.array(cols["pairs"], pa.binary()),
                     pa.array(cols["groups"], pa.string())],
                    ["doc_id", *_COUNTS, "groups_sha256", "pairs", "groups"])

    path = shared_path(spark, "align")
    (rows.mapInArrow(cut, _STORED).withColumn("row", F.monotonically_increasing_id())
     .write.option("compression", "zstd").parquet(path))
    stored = spark.read.parquet(path)
    counts = _pair_counts(stored)
    least, more = _frequent(counts, frequent)
    table = counts.filter(F.col("n") >= least) if least is not None else counts.limit(0)
    known = table.select("pair", "n", "best").orderBy("pair").toArrow()     # ``frequent`` rows at most
    pair, n, best = (known.column(c).to_numpy() for c in ("pair", "n", "best"))
    best = best.astype(np.int64)
    names = ["doc_id", *_COUNTS, "groups_sha256", "row", *(["groups"] if with_groups else [])]

    def look_up(batch):
        mine, times, ends = _pairs_of(batch.column("pairs"))
        at = np.minimum(np.searchsorted(pair, mine), max(len(pair) - 1, 0))
        found = pair[at] == mine if len(pair) else np.zeros(len(mine), bool)
        return mine, times, ends, at, found

    def add_up(batches):
        for batch in batches:
            mine, times, ends, at, found = look_up(batch)
            at, t = at[found], times[found]
            sums = [np.concatenate([[0], np.cumsum(np.bincount(np.flatnonzero(found), v, len(mine)).astype(np.int64)
                                                   if len(mine) else v)])
                    for v in ((t * best[at]).astype(float), (t * n[at]).astype(float))]
            per = [np.diff(np.concatenate([[0], s[ends]])) for s in sums]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(p.astype(np.int64)) for p in per],
                [*names, "n_best", "count_sum"])

    def others(batches):
        for batch in batches:
            mine, times, ends, _, found = look_up(batch)
            of = np.searchsorted(ends, np.flatnonzero(~found), side="right")
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column("row").to_numpy()[of]), pa.array(mine[~found]), pa.array(times[~found])],
                ["row", "pair", "times"])

    types = ", ".join(f"{c} {stored.schema[c].dataType.simpleString()}" for c in names)
    out = stored.select(*names, "pairs").mapInArrow(add_up, f"{types}, n_best long, count_sum long")
    if more:
        rest = (stored.select("row", "pairs").mapInArrow(others, "row long, pair long, times long")
                .join(counts.filter(F.col("n") < least) if least is not None else counts, "pair")
                .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                                    F.sum(F.col("times") * F.col("n")).alias("more_sum")))
        out = out.join(rest, "row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return out.select("doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256",
                      *(["groups"] if with_groups else []))


def _pair_counts(stored: DataFrame) -> DataFrame:
    """(pair, a, n, best): in how many documents a pair is linked."""
    counts = (stored.select("pairs").mapInArrow(_count, "pair long, n long")
              .groupBy("pair").agg(F.sum("n").alias("n"))
              .withColumn("a", F.shiftright("pair", 32)))
    counts = reliable(counts)
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return reliable(counts.join(most, "a").select("pair", "a", "n", (F.col("n") == F.col("most")).alias("best")))
