"""Exact top-k search by term-at-a-time accumulation.

Vectors are sparse rows of (term, weight); the score of a candidate is the
integer inner product.  Distinct (id, vector) queries are taken in blocks of
bounded size, one after the other: only one block is on the driver, from where
it goes to every task, and its lists are in the shared checkpoint folder before
the next one is collected.  A task turns a slice of candidates into posting lists (term ->
rows and weights), and for each term of a query adds query weight x posting
weights to a dense array of scores.  Each slice's best k of each query are
selected, a task keeps k of its slices, and the tasks' lists meet in a window
per query.  Queries and posting lists hold non-zero weights only: a very long
vector among short ones costs its own length.  Candidates are never shuffled or collected, and all of them are
scored, for whatever blocks of queries there are.

Defined results: vectors that are null, or hold a null or a non-finite
component, take no part, as query or candidate, nor do rows with a null id;
scores are exact whatever the weights, and a weight or score that does not fit
a long is an error; an empty vector scores 0 with all;
of vectors of different lengths the missing terms count as 0; a query's own
row is every candidate with its id; repeated candidate rows each take a rank
and repeated query rows each give a list; ties go to the smaller id; fewer
candidates than k give a shorter list; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.llm.common import reliable, shared_path

SLICE = 4096
TILE = 64       # queries whose scores are accumulated together
REPEATS = 1000


def weights(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
            scale: int = 256) -> DataFrame:
    """(id, w): w holds floor(scale * component), components as doubles."""
    def weight(x):
        wide = x.cast("double") * scale
        return F.when((wide >= -2.0 ** 63) & (wide < 2.0 ** 63), F.floor(wide)) \
            .otherwise(F.raise_error(F.concat(F.lit("weight does not fit a long: "), wide.cast("string"))).cast("long"))

    scaled = F.transform(F.col(vector_col), weight)
    good = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & good) \
        .select(F.col(id_col).cast("long").alias("id"), scaled.alias("w"))


def by_term(vectors: pa.Array, rows: slice = slice(None)) -> dict:
    """term -> (rows, weights) of the non-zero weights, from the lists' offsets:
    as large as the lists together, whatever the longest of them is."""
    offsets = vectors.offsets.to_numpy()
    sizes, flat = np.diff(offsets), vectors.values.to_numpy()[offsets[0]:offsets[-1]]
    first = (offsets[:-1] - offsets[0])[rows]
    sizes = sizes[rows]
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)    # place in its vector
    w = flat[np.repeat(first, sizes) + at]
    used = np.flatnonzero(w)
    used = used[np.argsort(at[used], kind="stable")]
    row, term, w = np.repeat(np.arange(len(sizes)), sizes)[used], at[used], w[used]
    terms, cuts = np.unique(term, return_index=True)
    cuts = np.append(cuts, len(term))
    return {int(t): (row[a:b], w[a:b]) for t, a, b in zip(terms, cuts, cuts[1:])}


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best scores, ties to the smaller id."""
    n = len(scores)
    if n > k:
        least = np.partition(scores, n - k)[n - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(n)
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def postings(candidates: pa.Array) -> dict:
    """term -> (rows or None for all, weights): the posting list of each term
    that some row has; lists of more than half of the rows are kept dense."""
    out, n = by_term(candidates), len(candidates)
    for term, (rows, w) in out.items():
        if 2 * len(rows) > n:
            column = np.zeros(n, w.dtype)
            column[rows] = w
            out[term] = None, column
    return out


def accumulate(tiles: list, lists: dict, n: int) -> np.ndarray:
    """Scores (queries x ``n`` candidates).  ``tiles`` holds (number of queries,
    their weights by term); in each, one term after the other scatters query
    weight x posting weights into the scores."""
    kind = next((w.dtype for _, w in lists.values()), np.dtype(np.int64))
    scores = np.zeros((sum(m for m, _ in tiles), n), kind)
    lo = 0
    for m, asking in tiles:
        part, buffer = scores[lo:lo + m], np.empty((m, n), kind)
        lo += m
        for term in asking.keys() & lists.keys():
            (asked, weight), (rows, w) = asking[term], lists[term]
            weight = weight[:, None]
            if rows is None and len(asked) == m:
                part += np.multiply(weight, w, out=buffer)
            elif rows is None:
                part[asked] += weight * w
            else:
                part[np.ix_(asked, rows)] += weight * w
    return scores


def _sizes(lists: dict) -> dict:
    return {t: (rows, np.abs(w.astype(float))) for t, (rows, w) in lists.items()}


def check_wide(scores: np.ndarray, tiles: list, query_ids: np.ndarray, queries: pa.Array, lists: dict,
               candidates: pa.Array, ids: np.ndarray) -> None:
    """Puts right the scores of candidates whose products or sums may not have
    fitted a long; ``queries`` and ``candidates`` are the vectors themselves."""
    sizes = [(m, _sizes(asking)) for m, asking in tiles]
    most = max((w.max() for _, w in _sizes(lists).values()), default=0.0)
    total = 0.0
    for m, asking in sizes:
        sums = np.zeros(m)
        for rows, w in asking.values():
            sums[rows] += w
        total = max(total, sums.max(initial=0.0))
    if total * most < 2.0 ** 62:
        return
    for i, j in zip(*np.nonzero(accumulate(sizes, _sizes(lists), len(ids)) >= 2.0 ** 62)):
        if query_ids[i] == ids[j]:
            continue
        score = sum(x * y for x, y in zip(queries[int(i)].as_py(), candidates[int(j)].as_py()))
        if not -2 ** 63 <= score < 2 ** 63:
            raise OverflowError(f"score {score} does not fit a long")
        scores[i, j] = score


def top_k(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
          every: int = 50, scale: int = 256, block: int = 4096) -> DataFrame:
    """(query_id, rank, id, score): the k best candidates of every row whose
    id is divisible by ``every``."""
    rows = weights(vectors, id_col=id_col, vector_col=vector_col, scale=scale)
    spark = vectors.sparkSession
    asked = reliable(rows.filter(F.col("id") % every == 0).groupBy("id", "w").agg(F.count("*").alias("times")))
    n = asked.count()
    blocks = max(1, -(-n // (block // 2)))
    root = shared_path(spark, "topk")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    for b in range(blocks):
        # about half a block: rows are dealt by id and vector, and no two are alike
        part = asked.filter(F.pmod(F.hash("id", "w"), F.lit(blocks)) == b).toArrow()
        _search(rows, part, k).withColumn("rank", F.row_number().over(order)) \
            .filter(F.col("rank") <= k).drop("query").write.parquet(f"{root}/{b}")
    found = spark.read.schema("query_id long, times long, id long, score long, rank int") \
        .parquet(*[f"{root}/{b}" for b in range(blocks)])
    return _repeated(found).select("query_id", "rank", "id", "score")


def _repeated(found: DataFrame) -> DataFrame:
    """Each row ``times`` times: first as rows of at most REPEATS, which are
    dealt out anew, so that no task has all of a very common query."""
    dealt = found.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / REPEATS)))) \
        .withColumn("left", F.least(F.lit(REPEATS), F.col("times") - F.col("part") * REPEATS).cast("int"))
    once, more = dealt.filter("times = 1"), dealt.filter("times > 1").repartition(
        max(1, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return once.unionByName(more.withColumn("left", F.explode(F.array_repeat(F.lit(1), F.col("left")))))


def _search(rows: DataFrame, queries: pa.Table, k: int) -> DataFrame:
    """The best k candidates of each query in each task."""
    query_ids, times = queries.column("id").to_numpy(), queries.column("times").to_numpy()
    query_w = queries.column("w").combine_chunks() if queries.num_rows else pa.array([], pa.list_(pa.int64()))
    if isinstance(query_w, pa.ChunkedArray):
        query_w = query_w.chunk(0)

    def run(batches):
        tiles = [(min(TILE, len(query_ids) - lo), by_term(query_w, slice(lo, lo + TILE)))
                 for lo in range(0, len(query_ids), TILE)]
        kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in query_ids]
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                ids = part.column("id").to_numpy()
                candidates = part.column("w")
                lists = postings(candidates)
                for lo in range(0, len(query_ids), 8 * TILE):
                    some = tiles[lo // TILE:lo // TILE + 8]
                    scores = accumulate(some, lists, len(ids))
                    check_wide(scores, some, query_ids[lo:lo + 8 * TILE], query_w[lo:lo + 8 * TILE], lists,
                               candidates, ids)
                    for q, row in enumerate(scores, lo):
                        pick = best(row, ids, k + 1)
                        pick = pick[ids[pick] != query_ids[q]]
                        if len(pick) < k and len(ids) > len(pick) + 1:   # its id is repeated
                            other = np.flatnonzero(ids != query_ids[q])
                            pick = other[best(row[other], ids[other], k)]
                        i = np.concatenate([kept[q][0], ids[pick]])
                        s = np.concatenate([kept[q][1], row[pick]])
                        top = best(s, i, k)
                        kept[q] = i[top], s[top]
        sizes = [len(i) for i, _ in kept]
        if sum(sizes):
            query = np.repeat(np.arange(len(query_ids)), sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query), pa.array(query_ids[query]), pa.array(times[query]),
                 pa.array(np.concatenate([i for i, _ in kept])),
                 pa.array(np.concatenate([s for _, s in kept]))],
                ["query", "query_id", "times", "id", "score"])

    return rows.mapInArrow(run, "query long, query_id long, times long, id long, score long")
