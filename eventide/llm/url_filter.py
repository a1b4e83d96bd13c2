"""URL rules by blocked Bloom filter and exact join.

A rule is a host and the beginning of a path.  It fits its host and all
subdomains if the URL's path starts with the rule's; of several the longest
one decides.  A URL's possible keys are the ends of its host at label borders
times the beginnings of its path of the lengths that rules have; ends longer
than the longest rule's host are not built.  A blocked
Bloom filter of the rules (blocks of 512 bits, one bit in each of a block's
eight words) passes the keys that may be listed; these are joined exactly
with the rule table, which removes false positives.  The filter has at most
``max_blocks`` blocks; a fuller filter only passes more keys to the join.

Defined results: a null URL or one without ``://`` has an empty host and path
and no rule; without a rule the verdict is ``default``; rules are canonical
(host A-Z lower-cased); rules with a null host or path are ignored; of rules
of equal length the one with the longer host, then ``block`` before ``allow``,
wins; repeated rows are repeated; empty tables are fine; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import lower_ascii

_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
SEED = 42       # the seed of Spark's xxhash64


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) as a rule sees them."""
    scheme, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end].translate(_LOWER), rest[end:]
    return host, rest[:min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))]


def host_ends(host: str, longest: int) -> list[str]:
    """The host and its parent domains, of at most ``longest`` characters."""
    out = [host] if len(host) <= longest else []
    dot = host.find(".", max(0, len(host) - longest - 1))
    while dot >= 0:
        out.append(host[dot + 1:])
        dot = host.find(".", dot + 1)
    return out


def _key(host: str, path: str) -> str:
    return f"{host}\n{path}"


def blocks_of(h: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and the bit (0-63) it sets in each of its eight words."""
    block = ((h >> np.uint64(32)) % np.uint64(n_blocks)).astype(np.int64)
    low = h & np.uint64(0xFFFFFFFF)
    salts = np.arange(1, 16, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return block, (low[:, None] * salts) >> np.uint64(58)


def build_filter(keys: DataFrame, max_blocks: int) -> np.ndarray:
    """Filter of the column ``key``: tasks set their bits, equal words meet by
    ``bit_or``, at most ``8 * max_blocks`` words reach the driver."""
    n_blocks = int(min(max_blocks, max(16, -(-keys.count() * 16 // 512))))
    hashes = keys.select(F.xxhash64("key").alias("h"))

    def bits(batches):
        for b in batches:
            block, bit = blocks_of(b.column("h").to_numpy().view(np.uint64), n_blocks)
            word = (block[:, None] * 8 + np.arange(8)).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(word), pa.array((np.uint64(1) << bit.ravel()).view(np.int64))], ["word", "bits"])

    words = hashes.mapInArrow(bits, "word long, bits long").groupBy("word") \
        .agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    out = np.zeros(8 * n_blocks, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out.reshape(n_blocks, 8)


def may_hold(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    block, bit = blocks_of(h, len(filter_))
    return ((filter_[block] >> bit) & np.uint64(1) == 1).all(axis=1)


def canonical_rules(rules: DataFrame, host_col: str = "host", path_col: str = "path",
                    verdict_col: str = "verdict") -> DataFrame:
    return rules.filter(F.col(host_col).isNotNull() & F.col(path_col).isNotNull()) \
        .select(lower_ascii(F.col(host_col)).alias("rule_host"), F.col(path_col).alias("rule_path"),
                F.col(verdict_col).alias("rule_verdict")) \
        .withColumn("key", F.concat("rule_host", F.lit("\n"), "rule_path"))


def judge(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow", max_blocks: int = 1 << 16) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``."""
    listed = canonical_rules(rules)
    filter_ = build_filter(listed, max_blocks)
    lengths = sorted(r.n for r in listed.select(F.length("rule_path").alias("n")).distinct().collect())
    longest = listed.agg(F.max(F.length("rule_host"))).first()[0] or 0
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"),
                        F.col(url_col).alias("url"))
    id_type = rows.schema["page_id"].dataType.simpleString()

    def keys(batches):
        for b in batches:
            hosts, paths, own, owner = [], [], [], []
            for i, url in enumerate(b.column("url").to_pylist()):
                host, path = split_url(url)
                hosts.append(host)
                paths.append(path)
                starts = [path[:n] for n in lengths if n <= len(path)]
                ends = host_ends(host, longest)
                own += [_key(h, p) for h in ends for p in starts]
                owner += [i] * (len(starts) * len(ends))
            h = np.fromiter((xxhash.xxh64_intdigest(k.encode("utf-8", "replace"), SEED) for k in own),
                            np.uint64, len(own))
            found = [[] for _ in hosts]
            for at in np.flatnonzero(may_hold(filter_, h)):
                found[owner[at]].append(own[at])
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("page_id"), pa.array(hosts, pa.string()),
                 pa.array(paths, pa.string()), pa.array(found, pa.list_(pa.string()))],
                ["row", "page_id", "host", "path", "keys"])

    possible = rows.mapInArrow(keys, f"row long, page_id {id_type}, host string, path string, "
                                     f"keys array<string>")
    # rows without a key get one of their own, that no rule has: nulls would meet in one task
    each = possible.withColumn("key", F.explode(F.when(F.size("keys") > 0, F.col("keys"))
                                                .otherwise(F.array(F.col("row").cast("string"))))).drop("keys")
    hit = each.join(listed, "key", "left")
    rank = F.when(F.col("rule_host").isNotNull(), F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("host"),
        F.col("rule_verdict").alias("verdict"), F.concat("rule_host", "rule_path").alias("rule")))
    decided = hit.groupBy("row", "page_id", "host", "path").agg(F.max(rank).alias("best"))
    return decided.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                          F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
