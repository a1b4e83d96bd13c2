"""Prefix trie of conversations on minimal-perfect-hash node tables.

A node is a sequence of first turns (role, text) that at least one
conversation starts with; the root is the empty sequence.  The operator gives
every node its members, children, the leaves below it and the tokens that a
shared prefix saves.

Plan.  (1) Turns are numbered in order, per conversation.  (2) The digest of a
prefix is a running sum over turns of two 64-bit hashes of (place, role, text),
mixed: an ordered scan that splits long conversations into slices, so no
conversation is one task's work.  (3) Rows are grouped by digest, combined
before the shuffle: one row per node, with its members, smallest member and
*weight*, the rows in its subtree.  (4) Nodes of more than ``fragment_rows``
weight are the top of the trie; every other node belongs to the fragment below
its first light ancestor, so a first turn that a third of all conversations
share is split at the turns after it.  (5) Fragments are dealt out to shards by
hash.  A shard enumerates its distinct digests, gives each a slot with a
minimal perfect hash (``PerfectHash``; every look-up is compared with the slot's
whole digest), scatters counts into flat arrays and adds them up through the
array of parent slots, deepest level first.  (6) The top's sums over
descendants come from pointer doubling, joins that double the distance each
round, so its depth costs rounds in its logarithm.

The members that end at a node are listed in numeric order in pieces, sorted
by range, and hashed piece after piece: a node at which a third of all
conversations end is never one row.  Its hash is one pass over the pieces, as
SHA-256 demands.

Order of turns: by turn (null first), then role, then the hash of the text.
Defined results: a null role or text is empty; rows with a null conversation id
are in no conversation; repeated rows are turns of their own; a conversation
without turns is a member of the root alone; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import mix64, reliable
from eventide.plans.keyed import keyed, scan

WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()
_SUM = "decimal(38,0)"
# Bytes of an ending members' piece.
_PIECE = 1 << 18


# ------------------------------------------------------- perfect hash table
class PerfectHash:
    """Slots 0 to n - 1 of n distinct 128-bit digests.  Level by level, digests
    that alone hit a bit of the level's array are placed there, the others go
    on; a slot is the rank of its bit.  ``slots`` compares whole digests."""

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.levels, self.high, self.low = [], np.zeros(len(high), np.uint64), np.zeros(len(high), np.uint64)
        left, base = np.arange(len(high)), 0
        while len(left):
            if len(self.levels) > 64:
                raise ValueError("digests are not distinct")
            size = 2 * len(left)
            at = self._spot(high[left], low[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            rank = base + np.cumsum(alone) - 1
            placed = alone[at]
            slot = rank[at[placed]]
            self.high[slot], self.low[slot] = high[left[placed]], low[left[placed]]
            self.levels.append((size, alone, rank))
            base += int(alone.sum())
            left = left[~placed]

    @staticmethod
    def _spot(high, low, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix64(high ^ mix64(low + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))
                    % np.uint64(size)).astype(np.int64)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slots of digests; raises if one of them is not in the table."""
        out = np.full(len(high), -1)
        left = np.arange(len(high))
        for level, (size, alone, rank) in enumerate(self.levels):
            at = self._spot(high[left], low[left], level, size)
            out[left[alone[at]]] = rank[at[alone[at]]]
            left = left[~alone[at]]
        if len(left) or (self.high[out] != high).any() or (self.low[out] != low).any():
            raise ValueError("a digest is not in the node table")
        return out


def accumulate(parent: np.ndarray, depth: np.ndarray, *values: np.ndarray) -> None:
    """Add each slot's value to its parent's, deepest level first, in place;
    a slot without a parent here has -1."""
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        inner = level[parent[level] >= 0]
        for v in values:
            np.add.at(v, parent[inner], v[inner])


def shard_tree(nodes: pa.Table) -> pa.Table:
    """The nodes of whole fragments with children, leaves and saved tokens of
    their subtrees, and their parents' smallest member where it is here."""
    col = {c: nodes.column(c).to_numpy() for c in
           ("high", "low", "up_high", "up_low", "depth", "conv_id", "n_convs", "words")}
    n = nodes.num_rows
    high, low, up_high, up_low = (col[c].astype(np.int64).view(np.uint64) for c in
                                  ("high", "low", "up_high", "up_low"))
    table = PerfectHash(high, low)
    slot = table.slots(high, low)
    inner = ~nodes.column("top").to_numpy().astype(bool)
    parent = np.full(n, -1)
    parent[slot[inner]] = table.slots(up_high[inner], up_low[inner])
    depth, conv, convs, words = (np.zeros(n, np.int64) for _ in range(4))
    for flat, c in ((depth, "depth"), (conv, "conv_id"), (convs, "n_convs"), (words, "words")):
        flat[slot] = col[c]
    children = np.zeros(n, np.int64)
    np.add.at(children, parent[parent >= 0], 1)
    leaves, saved = (children == 0).astype(np.int64), (convs - 1) * words
    accumulate(parent, depth, leaves, saved)
    at = parent[slot]
    cols = {"n_children": children, "n_leaves": leaves, "saved_tokens": saved}
    out = nodes.select(["high", "low", "up_high", "up_low", "depth", "conv_id", "n_convs", "top"])
    out = out.append_column("parent_conv_id", pa.array(conv[at], mask=at < 0))
    for name, flat in cols.items():
        out = out.append_column(name, pa.array(flat[slot]))
    return out


# -------------------------------------------------------------------- input
def ordered_turns(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv_id, place from 1, h1, h2, words): turns in order, texts as hashes."""
    r, t = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), r.alias("role"),
        F.xxhash64(F.lit(1), r, t).alias("h1"), F.xxhash64(F.lit(2), F.length(r), r, t).alias("h2"),
        F.regexp_count(t, F.lit(WORD)).cast("long").alias("words"))
    k = scan(keyed(rows, ["conv_id"], ["turn", "role", "h1", "h2"]), rn="place")
    return k.result().select("conv_id", F.col("place").cast("long").alias("place"), "h1", "h2", "words")


def share_openings(turns: DataFrame, *, every: int = 20, longest: int = 4) -> tuple[DataFrame, DataFrame]:
    """(rebuilt turns, conversations): each conversation c opens with the first
    h turns of conversation c - c % every, h = crc32(c as text) % longest, and
    goes on with its own turns after its first h."""
    turns = reliable(turns)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    convs = turns.select("conv_id").distinct().withColumns(
        {"h": h, "base": F.col("conv_id") - F.col("conv_id") % every})
    first = turns.filter((F.col("place") < longest) & (F.col("conv_id") % every == 0)) \
        .select(F.col("conv_id").alias("base"), "place", "h1", "h2", "words")
    opening = convs.join(first, "base").filter("place <= h") \
        .select("conv_id", F.lit(0).alias("side"), "place", "h1", "h2", "words")
    own = turns.filter(F.col("place") > h).select("conv_id", F.lit(1).alias("side"), "place", "h1", "h2", "words")
    k = scan(keyed(opening.unionByName(own), ["conv_id"], ["side", "place"]), rn="d")
    return k.result().select("conv_id", F.col("d").cast("long").alias("place"), "h1", "h2", "words"), \
        convs.select("conv_id")


# --------------------------------------------------------------------- trie
def _mixed(a, b, depth):
    """The digest's two halves from the running sums."""
    return F.xxhash64(a, b, depth), F.xxhash64(F.lit(3), b, a, depth)


def prefix_trie(turns: DataFrame, convs: DataFrame | None = None, *, fragment_rows: int = 4096,
                shard_rows: int = 100_000) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, place (from 1, without gaps), h1 and h2 (hashes of
    role and text) and words, as ``ordered_turns`` gives; ``convs`` adds
    conversations (conv_id) without turns."""
    # numbers of turns: the last place of a conversation is its length
    paths = turns.select("conv_id", "place", "words",
                         F.xxhash64("h1", "place").cast(_SUM).alias("x"),
                         F.xxhash64("h2", F.lit(5), "place").cast(_SUM).alias("y"))
    k = scan(keyed(paths, ["conv_id"], ["place"]), sums={"sx": F.col("x"), "sy": F.col("y")})
    sx, sy, x, y = (F.col(c).cast(_SUM) for c in ("sx", "sy", "x", "y"))
    high, low = _mixed(sx, sy, F.col("place"))
    up_high, up_low = _mixed(sx - x, sy - y, F.col("place") - 1)
    root_high, root_low = _mixed(F.lit(0).cast(_SUM), F.lit(0).cast(_SUM), F.lit(0).cast("long"))
    rows = k.result().select("conv_id", F.col("place").alias("depth"), "words", high.alias("high"), low.alias("low"),
                             up_high.alias("up_high"), up_low.alias("up_low"))
    lengths = rows.groupBy("conv_id").agg(F.max("depth").alias("len"))
    if convs is not None:
        lengths = convs.select(F.col("conv_id").cast("long")).distinct().join(lengths, "conv_id", "left") \
            .withColumn("len", F.coalesce("len", F.lit(0)))
    lengths = reliable(lengths)
    rows = reliable(rows.join(lengths, "conv_id"))
    nodes = rows.groupBy("high", "low").agg(
        F.first("up_high").alias("up_high"), F.first("up_low").alias("up_low"), F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("words").alias("words"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight"))
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0") \
        .select(root_high.alias("high"), root_low.alias("low"), F.lit(None).cast("long").alias("up_high"),
                F.lit(None).cast("long").alias("up_low"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
                F.lit(0).cast("long").alias("words"), F.lit(None).cast("long").alias("weight"))
    nodes = reliable(nodes.unionByName(root))
    heavy = F.col("weight").isNull() | (F.col("weight") > fragment_rows)
    top = reliable(nodes.filter(heavy).drop("weight"))
    light = _fragments(rows, nodes.filter(~heavy).drop("weight"), top)
    n, = light.agg(F.count(F.lit(1))).first()
    shards = max(_partitions(turns), n // shard_rows + 1)
    trees = light.withColumn("shard", F.pmod(F.xxhash64("root_high", "root_low"), F.lit(shards))) \
        .withColumn("top", (F.col("high") == F.col("root_high")) & (F.col("low") == F.col("root_low"))) \
        .drop("root_high", "root_low") \
        .groupBy("shard").applyInArrow(
            shard_tree,
            "high long, low long, up_high long, up_low long, depth long, conv_id long, n_convs long, top boolean, "
            "parent_conv_id long, n_children long, n_leaves long, saved_tokens long")
    trees = reliable(trees)
    above = _top(top, trees.filter("top"))
    named = trees.join(top.select(F.col("high").alias("up_high"), F.col("low").alias("up_low"),
                                  F.col("conv_id").alias("above")), ["up_high", "up_low"], "left") \
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    cols = ["high", "low", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    every = named.select(*cols).unionByName(above.select(*cols))
    ends = rows.filter("depth = len").select("high", "low", "conv_id").unionByName(
        lengths.filter("len = 0").select(root_high.alias("high"), root_low.alias("low"), "conv_id"))
    return every.join(_ends(ends), ["high", "low"], "left") \
        .select(*cols[2:], F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _fragments(rows: DataFrame, light: DataFrame, top: DataFrame) -> DataFrame:
    """``light`` with root_high and root_low: the first light node on the path
    of the node's smallest member, which is its ancestor or itself."""
    marks = top.select("high", "low", F.lit(True).alias("heavy"))
    first = rows.join(marks, ["high", "low"], "left").filter("heavy is null").groupBy("conv_id") \
        .agg(F.min(F.struct("depth", "high", "low")).alias("f")) \
        .select("conv_id", F.col("f.high").alias("root_high"), F.col("f.low").alias("root_low"))
    # written first, so that the join can split a conversation with very many nodes
    return reliable(light.join(reliable(first), "conv_id"))


def _top(top: DataFrame, below: DataFrame) -> DataFrame:
    """The nodes above all fragments: own values and those of the fragments
    under them, then sums over descendants by pointer doubling.  After round k
    a node's sums cover the nodes less than 2^k below it, and ``hop`` is its
    2^k-th ancestor."""
    key, up = ["high", "low"], ["up_high", "up_low"]
    hung = below.groupBy(*up).agg(F.count(F.lit(1)).alias("n"), F.sum("n_leaves").alias("l"),
                                  F.sum("saved_tokens").alias("s")).withColumnsRenamed({"up_high": "high", "up_low": "low"})
    own = top.filter("up_high is not null").groupBy(*up).agg(F.count(F.lit(1)).alias("m")) \
        .withColumnsRenamed({"up_high": "high", "up_low": "low"})
    parents = top.select(F.col("high").alias("up_high"), F.col("low").alias("up_low"),
                         F.col("conv_id").alias("parent_conv_id"))
    state = top.join(hung, key, "left").join(own, key, "left").join(parents, up, "left").select(
        *key, "conv_id", "depth", "parent_conv_id", "n_convs",
        (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n_children"),
        (F.coalesce("l", F.lit(0)) + F.when(F.col("n").isNull() & F.col("m").isNull(), 1).otherwise(0)).alias("n_leaves"),
        (F.coalesce("s", F.lit(0)) + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        F.col("up_high").alias("hop_high"), F.col("up_low").alias("hop_low"))
    state = reliable(state)
    hop = ["hop_high", "hop_low"]
    while not state.filter("hop_high is not null").isEmpty():
        sent = state.filter("hop_high is not null").groupBy(*hop) \
            .agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")) \
            .withColumnsRenamed({"hop_high": "high", "hop_low": "low"})
        far = state.select(F.col("high").alias("hop_high"), F.col("low").alias("hop_low"),
                           F.col("hop_high").alias("far_high"), F.col("hop_low").alias("far_low"))
        state = reliable(state.join(sent, key, "left").join(far, hop, "left").select(
            *key, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens"),
            F.col("far_high").alias("hop_high"), F.col("far_low").alias("hop_low")))
    return state


def _ends(ends: DataFrame) -> DataFrame:
    """(high, low, ends_sha256): ids that end at a node, ascending, hashed."""
    parts = _partitions(ends)
    piece = ends.repartitionByRange(parts, "high", "low", "conv_id").sortWithinPartitions("high", "low", "conv_id") \
        .mapInArrow(_pieces, "high long, low long, first long, ids string")
    return piece.repartition(parts, "high", "low").sortWithinPartitions("high", "low", "first") \
        .mapInArrow(_hashes, "high long, low long, ends_sha256 string")


def _pieces(batches):
    """Sorted (node, id) rows to one row per run of a node, cut at ``_PIECE`` bytes."""
    node, ids, size = None, [], 0

    def piece():
        return pa.RecordBatch.from_arrays(
            [pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([int(ids[0])], pa.int64()),
             pa.array([",".join(ids)])], ["high", "low", "first", "ids"])

    for batch in batches:
        for high, low, conv in zip(*(batch.column(c).to_pylist() for c in ("high", "low", "conv_id"))):
            if node != (high, low) or size > _PIECE:
                if ids:
                    yield piece()
                node, ids, size = (high, low), [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        yield piece()


def _hashes(batches):
    node, sha = None, None
    done: list = []

    def result():
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()),
                                           pa.array([d[1] for d in done], pa.int64()),
                                           pa.array([d[2] for d in done], pa.string())], ["high", "low", "ends_sha256"])

    for batch in batches:
        for high, low, ids in zip(*(batch.column(c).to_pylist() for c in ("high", "low", "ids"))):
            if node != (high, low):
                if sha:
                    done.append((*node, sha.hexdigest()))
                node, sha = (high, low), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        if len(done) > 5000:
            yield result()
            done = []
    if sha:
        done.append((*node, sha.hexdigest()))
    yield result()
