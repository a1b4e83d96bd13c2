"""Benchmark decontamination by winnowing.

Texts become words (``common.WORD_BYTES``), words 64-bit hashes, and every
``gram`` consecutive words one k-gram hash.  Of each ``span - gram + 1``
consecutive k-grams the smallest hash is kept, with the rightmost one on
ties, so any ``span`` words that a document shares with an item have a kept
k-gram in common.  An item of fewer than ``span`` words is one window of its
own length; documents then keep every k-gram of that length too.

Plan.  Item fingerprints are a table (hash, item, words around it).  A Bloom
filter over their hashes, of at most ``max_filter_bits`` bits whatever the
benchmark's size, lets a map over the documents drop almost every
fingerprint that no item has; what passes is joined with the item table on
the hash, by whichever join the planner finds right for their sizes.  A
joined pair carries the words around both hits, so extending and verifying it
needs no text: it matches if the hit grows to at least the window length.
Matched intervals meet per document row and are united.  A saturated filter
only passes more fingerprints to the join; results do not change.

Defined results: null and empty texts have no words and are never hit; an
empty benchmark hits nothing; an item with a null id marks words but is not
counted or listed; repeated items count once per id, repeated document rows
are repeated in the result; ``items_sha256`` of no items is that of the empty
string; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import WORD_BYTES, free_name, mix64, quoted, reliable, sections, utf8

PROBES = 4
_PAD_DOC, _PAD_ITEM = 0, 1


def word_hashes(text: str | None) -> np.ndarray:
    """XXH64 of each word; 0 and 1 are kept free for padding."""
    digest = xxhash.xxh64_intdigest
    parts = []
    for piece in sections(utf8(text).translate(WORD_BYTES)):
        words = piece.split()
        parts.append(np.fromiter(map(digest, words), np.uint64, len(words)))
    h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return np.where(h < 2, np.uint64(2), h)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = np.full(n, k, np.uint64)
    for i in range(k):
        g = mix64(g * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n])
    return g


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest hash (the rightmost on ties) of every
    ``window`` consecutive ones."""
    n = len(grams) - window + 1
    if n <= 0 or window <= 1:
        return np.arange(len(grams)) if window <= 1 else np.zeros(0, np.int64)
    best, at = grams[:n].copy(), np.zeros(n, np.int64)
    for i in range(1, window):
        later = grams[i:i + n]
        smaller = later <= best
        best = np.where(smaller, later, best)
        at[smaller] = i
    return np.unique(at + np.arange(n))


def contexts(words: np.ndarray, at: np.ndarray, k: int, reach: int, pad: int) -> np.ndarray:
    """The words from ``reach`` before each k-gram to ``reach`` after it."""
    padded = np.concatenate([np.full(reach, pad, np.uint64), words, np.full(reach, pad, np.uint64)])
    return padded[at[:, None] + np.arange(k + 2 * reach)]


def _fixed_rows(a: np.ndarray) -> pa.Array:
    """Each row of 64-bit words as one binary value."""
    ends = np.arange(len(a) + 1, dtype=np.int32) * (8 * a.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(ends.tobytes()),
                                                       pa.py_buffer(np.ascontiguousarray(a).tobytes())])


def item_fingerprints(items: DataFrame, *, id_col: str, text_col: str, span: int,
                      gram: int) -> DataFrame:
    """(g, k, item, words_around) of every kept k-gram of the items."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    width = 2 * span - gram

    def run(batches):
        for b in batches:
            for item, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist()):
                words = word_hashes(text)
                if not len(words):
                    continue
                short = len(words) < span
                k = len(words) if short else gram
                g = gram_hashes(words, k)
                at = np.arange(1) if short else winnow(g, span - gram + 1)
                around = contexts(words, at, k, 0 if short else span - gram, _PAD_ITEM)
                around = np.pad(around, ((0, 0), (0, width - around.shape[1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[at].view(np.int64)), pa.array([k if short else 0] * len(at), pa.int32()),
                     pa.array([item] * len(at), pa.string()), _fixed_rows(around)],
                    ["g", "k", "item", "item_words"])

    return rows.mapInArrow(run, "g long, k int, item string, item_words binary")


def bloom_bits(grams: DataFrame, n: int, max_filter_bits: int) -> np.ndarray:
    """Bloom filter of the column g: 16 bits for each of ``n`` values within
    the bound, built by partial ``bit_or`` aggregates."""
    size = 1 << 12
    while size < min(16 * n, max_filter_bits):
        size *= 2
    probe = F.array(*[F.pmod(F.shiftrightunsigned("g", 16 * i), F.lit(size))
                      .bitwiseXOR(F.pmod(F.col("g"), F.lit(size))) if i else F.pmod(F.col("g"), F.lit(size))
                      for i in range(PROBES)])
    words = (grams.select(F.explode(probe).alias("p"))
             .groupBy(F.shiftright("p", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits")).toArrow())
    out = np.zeros(size // 64, np.uint64)
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def in_bloom(bits: np.ndarray, g: np.ndarray) -> np.ndarray:
    size = np.uint64(64 * len(bits) - 1)     # a power of two less one
    found = np.ones(len(g), bool)
    for i in range(PROBES):
        p = ((g >> np.uint64(16 * i)) ^ g) & size if i else g & size
        found &= (bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return found


def _extended(doc: np.ndarray, item: np.ndarray, k: np.ndarray, pos: np.ndarray, span: int, gram: int):
    """Grow each hit over equal words; (matched?, first word, end word)."""
    reach = span - gram
    same = doc == item
    left = np.cumprod(same[:, :reach][:, ::-1], axis=1).sum(1)
    right = np.cumprod(same[:, reach + gram:], axis=1).sum(1)
    whole = same[:, reach:reach + gram].all(axis=1)
    length = left + gram + right
    ok, lo, hi = whole & (length >= span), pos - left, pos + gram + right
    for m in np.unique(k[k > 0]):           # one-window items: their own words, no growth
        at = k == m
        ok[at] = same[at][:, :m].all(axis=1)
        lo[at], hi[at] = pos[at], pos[at] + m
    return ok, lo, hi


def hit_intervals(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id",
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  span: int = 10, gram: int = 5, max_filter_bits: int = 1 << 25) -> DataFrame:
    """(row, doc_id, text_hash, n_words, item, first, end): one row per
    document row with null first, and one per verified hit."""
    prints = reliable(item_fingerprints(items, id_col=item_id, text_col=item_text, span=span, gram=gram))
    bits = bloom_bits(prints, prints.count(), max_filter_bits)
    short = sorted(r.k for r in prints.filter("k > 0").select("k").distinct().collect())  # < span values
    width, reach = 2 * span - gram, span - gram
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))

    def scan(batches):
        for b in batches:
            texts, counts, found = b.column("text").to_pylist(), [], []
            for i, text in enumerate(texts):
                words = word_hashes(text)
                counts.append(len(words))
                for k in (0, *short):
                    g = gram_hashes(words, k or gram)
                    at = np.arange(len(g)) if k else winnow(g, span - gram + 1)
                    at = at[in_bloom(bits, g[at])]
                    if len(at):
                        around = contexts(words, at, k or gram, 0 if k else reach, _PAD_DOC)
                        found.append((i, k, at, g[at], around))
            base = pa.array(counts, pa.int64())
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), b.column("text_hash"), base,
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.binary())], names)
            if found:
                at = pa.array(np.concatenate([np.full(len(x[2]), x[0]) for x in found]))
                wide = np.concatenate([np.pad(x[4], ((0, 0), (0, width - x[4].shape[1])))
                                       for x in found])
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").take(at), b.column("doc_id").take(at),
                     b.column("text_hash").take(at), pa.nulls(len(at), pa.int64()),
                     pa.array(np.concatenate([x[3] for x in found]).view(np.int64)),
                     pa.array(np.concatenate([np.full(len(x[2]), x[1], np.int32) for x in found])),
                     pa.array(np.concatenate([x[2] for x in found]).astype(np.int64)),
                     _fixed_rows(wide)], names)

    names = ["row", "doc_id", "text_hash", "n_words", "g", "k", "pos", "doc_words"]
    hits = rows.mapInArrow(scan, "row long, doc_id long, text_hash long, n_words long, g long, "
                                 "k int, pos long, doc_words binary")
    # base rows have no hash; a spread key keeps them out of one partition
    left = hits.withColumn("j", F.coalesce("g", F.xxhash64("row"))) \
        .withColumn("jk", F.coalesce("k", F.lit(-1)))
    right = prints.select(F.col("g").alias("j"), F.col("k").alias("jk"), "item", "item_words")
    joined = left.join(right, ["j", "jk"], "left") \
        .filter(F.col("g").isNull() | F.col("item_words").isNotNull()) \
        .select("row", "doc_id", "text_hash", "n_words", "k", "pos", "doc_words", "item_words", "item")

    def verify(batches):
        for b in batches:
            hit = np.flatnonzero(b.column("k").is_valid().to_numpy(zero_copy_only=False))
            keep = b.column("k").is_null().to_numpy(zero_copy_only=False)
            lo = np.zeros(b.num_rows, np.int64)
            hi = np.zeros(b.num_rows, np.int64)
            if len(hit):
                part = b.take(pa.array(hit))
                both = [np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint64)
                        .reshape(-1, width) for c in ("doc_words", "item_words")]
                ok, first, end = _extended(*both, part.column("k").to_numpy(),
                                           part.column("pos").to_numpy(), span, gram)
                keep[hit[ok]] = True
                lo[hit], hi[hit] = first, end
            base = pa.array(b.column("k").is_null().to_numpy(zero_copy_only=False))
            out = pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("row", "doc_id", "text_hash", "n_words", "item")),
                 pa.array(lo, mask=base.to_numpy(zero_copy_only=False)),
                 pa.array(hi, mask=base.to_numpy(zero_copy_only=False))],
                ["row", "doc_id", "text_hash", "n_words", "item", "first", "end"])
            yield out.filter(pa.array(keep))

    return joined.mapInArrow(verify, "row long, doc_id long, text_hash long, n_words long, "
                                     "item string, first long, end long")


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document row: doc_id, text_hash, n_words, n_hit, items
    (sorted ids of the items with a window in it) and spans (the united hit
    intervals, in words, end exclusive)."""
    hits = hit_intervals(docs, items, **options)
    # the same interval of several items, or found by several hits, is one
    per = hits.groupBy("row", "doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("first").isNotNull(), F.struct("first", "end"))))
        .alias("found"),
        F.array_sort(F.collect_set("item")).alias("items"))
    empty = F.array().cast("array<struct<first:bigint,end:bigint>>")
    united = F.aggregate(
        "found", empty,
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["first"]),
                              F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
                                  F.element_at(acc, -1)["first"].alias("first"),
                                  F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(x))))
    return per.select("doc_id", "text_hash", "n_words", "items", united.alias("spans")) \
        .withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("bigint"),
                                         lambda acc, x: acc + x["end"] - x["first"]))


def drop_contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id",
                      text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs."""
    bad_id, bad_hash = free_name(docs, "_bad_id"), free_name(docs, "_bad_hash")
    rows = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    bad = contamination(rows, items, **options).filter("n_hit > 0") \
        .select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash))
    on = (F.col(quoted(id_col)).cast("long").eqNullSafe(F.col(bad_id))
          & (F.xxhash64(F.col(quoted(text_col))) == F.col(bad_hash)))
    return docs.join(bad, on, "left_anti")
