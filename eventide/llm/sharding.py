"""Balanced label propagation: documents to shards, linked ones together.

Links are groups: documents that share a group are linked, each with each,
without a row for a pair (an ordinary link is a group of two, see
``link_groups``).  Linked documents start in shards in turn and move in rounds:

1. Members are counted per group and shard, combined before the shuffle; the
   counts (one row per group, one column per shard) are joined back to the
   members and added up per document: its neighbours in every shard.
2. A document asks for the shard with most neighbours, if it gains by going.
   Where going and staying gain the same seen from both sides (two copies would
   change places for ever), only the way to the shard that a hash of group,
   shard and round prefers is open.
3. Requests are counted per (from, to, gain), at most shards^2 x 64 rows, and
   ``quotas`` grants as many as the shards' capacities allow: a shard takes in
   what it has room for and what leaves it, highest gains first.
   What they deny may still change places with documents that lose less by it
   (``exchanges``).  In every other round nobody asks for the shards that denied
   requests before, so that the rest of a group larger than a shard gathers in
   the next one.
4. Requests are ranked per (from, to) by gain and group, with hot pairs split
   into slices, and the granted ones move; the new state is checkpointed.

Rounds end when nothing moves in two of them, or after ``rounds``.  Capacities
are the exact sizes, so at the end the documents without links fill the shards
up: their running numbers are cut at the remaining rooms.  Shards then differ
by one row at most (law ``rows``), whatever the links.

Nothing but counts per (from, to, gain) and per partition reaches the driver.

Defined results: a null text has no bytes, size 1, crc 0, and is linked with
the empty text like a copy; null ids stay null; repeated rows are documents of
their own; tables with fewer rows than shards leave shards empty; an empty
table gives an empty result; other columns are ignored by ``shard_rows`` and
kept by ``write_shards``.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import reliable, shared_path
from eventide.plans.keyed import keyed, scan

LAW = "rows"


def capacities(rows: int, shards: int) -> list[int]:
    """Sizes of shards that differ by one at most."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def numbered(df: DataFrame, name: str, by: list[str]) -> DataFrame:
    """Gapless numbers from 0 within each ``by``, in the order of partitions
    and rows: counted within partitions by one map, then moved up by the
    counts of the partitions before.  ``df`` must be checkpointed: both jobs
    have to see the same partitions.  ``by`` has few values (integers)."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + ", _part int, _in long"

    def run(batches):
        from pyspark import TaskContext
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for b in batches:
            inside = []
            for k in zip(*(b.column(c).to_pylist() for c in by)) if by else [()] * b.num_rows:
                inside.append(seen[k])
                seen[k] += 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(inside, pa.int64())],
                [*b.schema.names, "_part", "_in"])

    rows = reliable(df.mapInArrow(run, schema))
    sizes = rows.groupBy("_part", *by).agg(F.count(F.lit(1)).alias("_n"))
    k = scan(keyed(sizes.withColumn("_all", F.lit(0)), by or ["_all"], ["_part"]), sums_before={"_base": F.col("_n")})
    base = k.result().select("_part", *by, "_base")
    return rows.join(base, ["_part", *by]).withColumn(name, F.col("_base") + F.col("_in")) \
        .drop("_part", "_in", "_base")


def quotas(asked: dict, load: list[int], cap: list[int]) -> dict:
    """Granted moves {(from, to): n} of ``asked`` {(from, to, gain): n}.

    Starts from all that is asked and takes back, lowest gains first, what a
    shard cannot hold after what leaves it; taking back may keep rows in
    another shard, so this goes on until every shard holds.  What remains is
    the largest such plan: exchanges between full shards, round trips over
    several included, stay in."""
    grant = dict(asked)
    while True:
        change = False
        for s in range(len(cap)):
            come = sum(n for (_, t, _), n in grant.items() if t == s)
            gone = sum(n for (f, _, _), n in grant.items() if f == s)
            over = load[s] + come - gone - cap[s]
            for key in sorted((k for k in grant if k[1] == s), key=lambda k: (k[2], k[0])):
                if over <= 0:
                    break
                back = min(over, grant[key])
                grant[key], over = grant[key] - back, over - back
                change = change or back > 0
        if not change:
            break
    out: dict = defaultdict(int)
    for (f, t, _), n in grant.items():
        out[f, t] += n
    return {k: n for k, n in out.items() if n}


def exchanges(denied: dict, stay: dict) -> tuple[dict, dict]:
    """Changes of places with documents that have no wish to move, for requests
    that ``quotas`` denied, {(from, to, gain level): n}.  ``stay`` is {(shard,
    loss level): n}: how many of them a shard has by the neighbours they would
    leave.  Best gains meet least losses, while the gain is surely larger.
    Returns (more moves {(from, to): n}, ranges of evicted ranks per shard
    {(shard, to): (first, last)})."""
    more, ranges = defaultdict(int), {}
    for t in sorted({t for _, t, _ in denied}):
        have = sorted([lv, n] for (s, lv), n in stay.items() if s == t)
        wish = sorted(((-lv, f, n) for (f, to, lv), n in denied.items() if to == t))
        by_from: dict = defaultdict(int)
        for lv, f, n in wish:
            while n and have and 1 << -lv > (1 << have[0][0]) - 1:     # least gain above largest loss
                k = min(n, have[0][1])
                by_from[f] += k
                n, have[0][1] = n - k, have[0][1] - k
                if not have[0][1]:
                    have.pop(0)
        rank = 0
        for f, k in sorted(by_from.items()):
            more[f, t] += k
            ranges[t, f] = (rank + 1, rank + k)
            rank += k
    return dict(more), ranges


def _requests(members: DataFrame, shards: int, round_no: int, closed: list[int]) -> DataFrame:
    """(node, grp, from, own, to, gain) of every linked document: the smallest
    group it is in, its neighbours in its own shard and, if it gains by moving,
    where to and how much."""
    # written first: a join side that is an aggregate of its own task cannot be split
    count = reliable(members.groupBy("grp").agg(*[F.sum((F.col("shard") == s).cast("long")).alias(f"c{s}")
                                                  for s in range(shards)]))
    seen = members.join(count, "grp").groupBy("node", "shard").agg(
        F.min("grp").alias("grp"), F.count(F.lit(1)).alias("groups"),
        *[F.sum(f"c{s}").alias(f"c{s}") for s in range(shards)])
    # in its own shard a document does not count itself
    own = F.element_at(F.array(*[F.col(f"c{s}") for s in range(shards)]), F.col("shard") + 1) - F.col("groups")

    def favour(s):
        return F.xxhash64("grp", s, F.lit(round_no))

    best = F.greatest(*[F.when((F.col("shard") != s) & (F.col(f"c{s}") > 0),
                               F.struct(F.col(f"c{s}").alias("n"), favour(F.lit(s)).alias("h"), F.lit(s).alias("s")))
                        for s in range(shards) if s not in closed] + [F.lit(None)] * 2)
    asked = seen.select("node", "grp", "groups", F.col("shard").alias("from"), own.alias("own"), best.alias("b")) \
        .withColumn("gain", F.col("b.n") - F.col("own"))
    one_way = (F.col("gain") > F.col("groups")) | (F.col("b.h") > favour(F.col("from")))
    goes = (F.col("gain") > 0) & one_way
    return asked.select("node", "grp", "from", "own", F.when(goes, F.col("b.s")).alias("to"), "gain")


def _granted(asked: DataFrame, load: list[int], cap: list[int]) -> tuple[DataFrame | None, list[int]]:
    """((node, moved) of the documents that move in this round, None if none
    do; the shards that could not take in all that asked)."""
    spark = asked.sparkSession
    level = F.floor(F.log2("gain")).cast("int")
    counts = asked.filter("to is not null").groupBy("from", "to", level.alias("level")).count().collect()
    wish = {(c["from"], c["to"], c["level"]): c["count"] for c in counts}
    grant = quotas(wish, load, cap)
    left, denied = dict(grant), {}
    for (f, t, lv), n in sorted(wish.items(), key=lambda x: -x[0][2]):      # highest gains go first
        k = min(n, left.get((f, t), 0))
        left[f, t] = left.get((f, t), 0) - k
        if n > k:
            denied[f, t, lv] = n - k
    ranges, full = {}, []
    if denied:
        loss = F.ceil(F.log2(F.col("own") + 1)).cast("int")
        stay = asked.filter("to is null").groupBy("from", loss.alias("level")).count().collect()
        more, ranges = exchanges(denied, {(c["from"], c["level"]): c["count"] for c in stay})
        full = sorted({t for f, t, _ in denied if more.get((f, t), 0) <
                       sum(n for (g, u, _), n in denied.items() if (g, u) == (f, t))})
        for k, n in more.items():
            grant[k] = grant.get(k, 0) + n
    if not grant:
        return None, full
    limits = spark.createDataFrame([(f, t, n) for (f, t), n in grant.items()], "from int, to int, n long")
    ranked = scan(keyed(asked.filter("to is not null").withColumn("less", -F.col("gain")),
                        ["from", "to"], ["less", "grp", "node"]), rn="rank").result()
    moves = ranked.join(limits, ["from", "to"]).filter("rank <= n").select("node", F.col("to").alias("moved"))
    if ranges:
        places = spark.createDataFrame([(s, t, lo, hi) for (s, t), (lo, hi) in ranges.items()],
                                       "from int, moved int, lo long, hi long")
        ranked = scan(keyed(asked.filter("to is null").join(places.select("from").distinct(), "from"),
                            ["from"], ["own", "grp", "node"]), rn="rank").result()
        moves = moves.unionByName(ranked.join(places, "from").filter("rank between lo and hi").select("node", "moved"))
    return moves, full


def propagate(members: DataFrame, cap: list[int], *, rounds: int = 16) -> DataFrame:
    """(node, shard) of the linked documents.  ``members`` has node, grp and
    the starting shard; a node in several groups has a row for each."""
    shards = len(cap)
    members = reliable(members)
    idle, full = 0, []
    for r in range(rounds):
        load = [0] * shards
        for s, n in members.groupBy("shard").agg(F.count_distinct("node")).collect():
            load[s] = n
        closed = full if r % 2 else []
        asked = reliable(_requests(members, shards, r, closed))
        moves, denied = _granted(asked, load, cap)
        full = denied or closed
        idle = idle + 1 if moves is None else 0
        if idle > 1:
            break
        if moves is not None:
            members = reliable(members.join(moves, "node", "left")
                               .select("node", "grp", F.coalesce("moved", "shard").alias("shard")))
    return members.select("node", "shard").distinct()


def text_groups(nodes: DataFrame) -> DataFrame:
    """(node, grp): the documents with equal texts, where there are several."""
    many = reliable(nodes.groupBy("text_hash", "size", "text_crc32").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("grp")).filter("n > 1").drop("n"))
    return nodes.join(many, ["text_hash", "size", "text_crc32"]).select("node", "grp")


def link_groups(links: DataFrame) -> DataFrame:
    """(node, grp) of links (a, b) between nodes: each is a group of two."""
    rows = reliable(links.select("a", "b", F.monotonically_increasing_id().alias("grp")))
    return rows.select(F.col("a").alias("node"), "grp").unionByName(rows.select(F.col("b").alias("node"), "grp"))


def cut_groups(members: DataFrame, shard_of: DataFrame) -> DataFrame:
    """(groups, cut): how many groups there are and lie in several shards."""
    return members.join(shard_of, "node").groupBy("grp").agg(F.count_distinct("shard").alias("k")) \
        .agg(F.count(F.lit(1)).alias("groups"), F.sum((F.col("k") > 1).cast("long")).alias("cut"))


def narrow_nodes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, doc_id, size, text_crc32, text_hash) of every row, written once;
    node is a number of its own for each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return reliable(docs.select(
        F.monotonically_increasing_id().alias("node"), F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash")))


def assign(nodes: DataFrame, members: DataFrame, *, shards: int = 16, rounds: int = 16) -> DataFrame:
    """``nodes`` (checkpointed, column node) with shard and slot; ``members``
    are the linked ones' groups (node, grp)."""
    total = nodes.count()
    cap = capacities(total, shards)
    members = reliable(members)
    linked = reliable(members.select("node").distinct())
    start = numbered(linked, "at", []).select("node", (F.col("at") % shards).cast("int").alias("shard"))
    placed = reliable(propagate(members.join(start, "node"), cap, rounds=rounds))
    load = [0] * shards
    for s, n in placed.groupBy("shard").count().collect():
        load[s] = n
    free = reliable(nodes.select("node").join(placed, "node", "left_anti"))
    # the others' running numbers, cut at the rooms that are left
    at, base, shard, slot = F.col("at"), 0, None, None
    for s in range(shards):
        room = cap[s] - load[s]
        mine, to = at < base + room, at - base + load[s]
        shard = F.when(mine, s) if shard is None else shard.when(mine, s)
        slot = F.when(mine, to) if slot is None else slot.when(mine, to)
        base += room
    filled = numbered(free, "at", []).select("node", shard.alias("shard"), slot.alias("slot"))
    first = numbered(placed.select("node", "shard"), "slot", ["shard"])
    both = first.select("node", "shard", "slot").unionByName(filled)
    return nodes.join(both, "node")


def shard_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = 16,
               rounds: int = 16) -> DataFrame:
    """One row per document, equal texts linked: doc_id, size, text_crc32, law,
    shard, slot, grown_shard (null: the law ``rows`` has no stable growth)."""
    nodes = narrow_nodes(docs, id_col=id_col, text_col=text_col)
    return assign(nodes, text_groups(nodes), shards=shards, rounds=rounds).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", shards: int = 16,
                 rounds: int = 16, members=text_groups) -> DataFrame:
    """Write the documents, all columns, into folders ``shard=0`` to
    ``shard=n`` below ``path`` in the order of their slots, and return them as
    read from there.  ``members`` makes (node, grp) of the nodes."""
    spark: SparkSession = docs.sparkSession
    if {"shard", "slot"} & {c.lower() for c in docs.columns}:
        raise ValueError("write_shards: columns shard and slot are its own")
    key = "_node"
    while key in docs.columns:
        key += "_"
    copy = shared_path(spark, "shards")
    docs.withColumn(key, F.monotonically_increasing_id()).write.parquet(copy)
    rows = spark.read.parquet(copy)
    text = F.coalesce(rows[text_col], F.lit(""))
    nodes = reliable(rows.select(rows[key].alias("node"), (F.octet_length(text) + 1).cast("long").alias("size"),
                                 F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash")))
    where = assign(nodes, members(nodes), shards=shards, rounds=rounds).select(F.col("node").alias(key), "shard", "slot")
    out = rows.join(where, key).drop(key)
    parts = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    out.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)
    return spark.read.parquet(path)
