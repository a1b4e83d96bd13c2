"""SimHash near-duplicates by multi-index hashing.

Every text becomes a 64-bit fingerprint: each bit is the majority vote of
that bit over the XXH64 hashes (seed 42) of its word shingles, repeats
included.  Two fingerprints link when they differ in at most ``max_bits``
bits; a component is everything reachable over links.

Plan.  (1) One Arrow map computes the fingerprints; the narrow result
``(id, text hash, fingerprint)`` is checkpointed.  (2) Fingerprints are
grouped, so copies, however many, are one row from here on.  (3) The 64 bits
are cut into ``segments``; two fingerprints within ``max_bits`` agree on some
segment up to ``max_bits // segments`` bits.  Each fingerprint is stored under
its segment values and looked up under every value in the small Hamming ball
around them; a joined pair is kept if the whole distance is small enough.  A
differing bit is only flipped from 0 to 1 on the probing side, so each pair
with one differing segment bit is met once.  (4) Segment values with more
than ``bucket_limit`` different fingerprints (one large group of near
copies) do not emit pairs: see ``_dense_links``.  (5) Components by
alternating large-star / small-star over the links, checkpointed each round.

Defined results: null and empty texts have no words, fingerprint zero, and
link like any other; repeated rows are repeated in the result; rows with a
null id take part, and a component without any id has a null component id;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import free_name, quoted, reliable, utf8

SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of one text.  ``bytes.lower`` changes A-Z only
    and ``bytes.split`` cuts at space and U+0009 to U+000D."""
    words = utf8(text).lower().split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n <= 1:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[:n].tolist()
    ends = (ends[shingle - 1:] - 1).tolist()
    line = b" ".join(words)
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        hashes = np.array([digest(line[s:e], SEED) for s, e in
                           zip(starts[at:at + 65536], ends[at:at + 65536])], dtype=">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): fp as a signed long, text_hash tells rows
    with equal or null ids apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.col(text_col)).alias("text_hash"),
                       F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()],
                           dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(fps, pa.int64())],
                ["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _segments(segments: int) -> list[tuple[int, int, int]]:
    """(index, shift, width) of each segment; widths differ by one at most."""
    cut = [64 * i // segments for i in range(segments + 1)]
    return [(i, cut[i], cut[i + 1] - cut[i]) for i in range(segments)]


def _balls(width: int, radius: int) -> list[int]:
    """Masks of up to ``radius`` bits within ``width`` bits (at most 63)."""
    masks, last = [0], [(0, -1)]
    for _ in range(radius):
        last = [(m | 1 << b, b) for m, at in last for b in range(at + 1, width)]
        masks += [m for m, _ in last]
    return masks


def _segment(fp: str, shift: int, width: int):
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _ball(val, width: int, radius: int):
    """Array of the values within ``radius`` bits of ``val``.  For radius 1
    only 0-to-1 flips: the other member of a pair flips the same bit back."""
    masks = F.array(*[F.lit(m).cast("long") for m in _balls(width, radius)])
    if radius == 1:
        masks = F.filter(masks, lambda m: m.bitwiseAND(val) == 0)
    return F.transform(masks, lambda m: m.bitwiseXOR(val))


def near_links(fps: DataFrame, *, max_bits: int = 3, segments: int = 2,
               bucket_limit: int = 512) -> DataFrame:
    """Links (a, b) among the distinct fingerprints of ``fps`` (column fp)
    that have the same components as all pairs within ``max_bits`` bits."""
    if segments < 2:
        raise ValueError("at least two segments")
    parts, radius = _segments(segments), max_bits // segments
    keys = [F.struct(F.lit(i).alias("seg"), _segment("fp", shift, width).alias("val"))
            for i, shift, width in parts]
    table = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.seg", "k.val")
    probe = None
    for i, shift, width in parts:
        one = fps.select(F.col("fp").alias("a"), F.lit(i).alias("seg"),
                         F.explode(_ball(_segment("fp", shift, width), width, radius)).alias("val"))
        probe = one if probe is None else probe.unionByName(one)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= max_bits
    own = F.col("a") != F.col("fp")
    dense = reliable(table.groupBy("seg", "val").count().filter(F.col("count") > bucket_limit)
                     .select("seg", "val"))
    if dense.isEmpty():
        return probe.join(table, ["seg", "val"]).filter(own & near) \
            .select("a", F.col("fp").alias("b"))
    thin = table.join(dense, ["seg", "val"], "left_anti")
    pairs = probe.join(thin, ["seg", "val"]).filter(own & near).select("a", F.col("fp").alias("b"))
    return pairs.unionByName(_dense_links(table, probe, dense, parts, max_bits))


def _dense_links(table, probe, dense, parts, max_bits) -> DataFrame:
    """Links of the segment values that very many fingerprints share, in rows
    that grow with the group, not with its square.

    All fingerprints met at a value ``k`` (stored there at segment distance
    d = 0, or probing at distance d) look at the rest of their bits.  A
    fingerprint marks every setting ``z`` of the rest within ``r`` bits of
    its own as "near" for ``d + r <= max_bits // 2`` and as "far" for
    ``d + r <= max_bits - max_bits // 2``.  Whoever is near at ``(k, z)`` is
    within ``max_bits`` of everyone near or far there, and any linked pair
    meets at some ``z`` between the two; so if somebody is near, everyone at
    ``(k, z)`` is linked to the smallest near fingerprint."""
    close, wide = max_bits // 2, max_bits - max_bits // 2
    met = (table.select("seg", "val", F.col("fp").alias("a"))
           .unionByName(probe.select("seg", "val", "a")).distinct()
           .join(dense, ["seg", "val"], "left_semi"))
    out = None
    for i, shift, width in parts:
        mask = ((1 << width) - 1) << shift
        signed = mask - (1 << 64) if mask >> 63 else mask
        here = met.filter(F.col("seg") == i)
        d = F.bit_count(_segment("a", shift, width).bitwiseXOR(F.col("val")))
        rest = F.col("a").bitwiseAND(F.lit(~signed))
        bits = [1 << b for b in range(64) if not mask >> b & 1]
        flips = [(m if m < 1 << 63 else m - (1 << 64), n) for m, n in _flips(bits, wide)]
        balls = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(n).alias("n"))
                          for m, n in flips])
        marks = (here.select("seg", "val", "a", d.alias("d"), rest.alias("rest"))
                 .select("seg", "val", "a", "d", "rest", F.explode(balls).alias("f"))
                 .filter(F.col("d") + F.col("f.n") <= wide)
                 .select("seg", "val", "a", F.col("rest").bitwiseXOR(F.col("f.m")).alias("z"),
                         (F.col("d") + F.col("f.n") <= close).alias("near")))
        hub = (marks.filter("near").groupBy("seg", "val", "z").agg(F.min("a").alias("b")))
        star = marks.join(hub, ["seg", "val", "z"]).filter("a <> b").select("a", "b").distinct()
        out = star if out is None else out.unionByName(star)
    return out


def _flips(bits: list[int], radius: int) -> list[tuple[int, int]]:
    found, last = [(0, 0)], [(0, -1)]
    for n in range(1, radius + 1):
        last = [(m | bits[b], b) for m, at in last for b in range(at + 1, len(bits))]
        found += [(m, n) for m, _ in last]
    return found


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of ``links`` (a, b): (node, root), the root being
    the smallest node; nodes without a link are left out.  Alternates
    large-star (each node's larger neighbours move to its smallest one) and
    small-star (the smaller ones do) until nothing moves, which takes few
    rounds even for long chains."""
    edges = reliable(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                     .distinct())
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))).distinct()
        edges = reliable(small)
        after = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if after == before:
            # stars: every node points at its root
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = after
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3, segments: int = 2,
                    bucket_limit: int = 512) -> DataFrame:
    """One row per document: doc_id, text_hash, fp, root (smallest
    fingerprint of the component) and component_id (smallest doc_id in it)."""
    fps = reliable(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    groups = reliable(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    links = near_links(groups.select("fp"), max_bits=max_bits, segments=segments,
                       bucket_limit=bucket_limit)
    comp = components(links)
    rooted = (groups.join(comp, F.col("fp") == F.col("node"), "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root") \
        .select("fp", "root", "component_id")
    return fps.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of every component the
    document with the smallest id (null ids last) stays, once."""
    found = near_duplicates(docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text")),
                            shingle=shingle, max_bits=max_bits)
    kept_id, kept_hash = free_name(docs, "_kept_id"), free_name(docs, "_kept_hash")
    stay = (found.groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("k"))
            .select(F.col("k.doc_id").alias(kept_id), F.col("k.text_hash").alias(kept_hash)))
    ids, text = F.col(quoted(id_col)).cast("long"), F.xxhash64(F.col(quoted(text_col)))
    on = ids.eqNullSafe(F.col(kept_id)) & (text == F.col(kept_hash))
    kept = docs.join(stay, on, "left_semi")
    if found.groupBy("doc_id", "text_hash").count().filter("count > 1").isEmpty():
        return kept
    # repeated rows of a kept document: the first of them stays
    row = free_name(docs, "_row")
    rows = reliable(kept.withColumn(row, F.monotonically_increasing_id()))
    once = rows.groupBy(ids.alias(kept_id), text.alias(kept_hash)).agg(F.min(row).alias(row)).select(row)
    return rows.join(once, row, "left_semi").drop(row)
