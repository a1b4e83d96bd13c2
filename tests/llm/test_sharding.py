"""Balanced label propagation: even shards, whole groups, gapless slots."""

import zlib
from collections import Counter, defaultdict

import pytest

from eventide.llm import sharding as S

DATA = "/root/testdata/sf0.001"


def check(rows, texts, shards):
    """Sizes, slots and digests of a result; the shards of each text."""
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == len(texts)
    assert sorted(sizes.get(s, 0) for s in range(shards)) == sorted(S.capacities(len(rows), shards))
    slots, where = defaultdict(list), defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    by_id = dict(texts)
    for r in rows:
        data = (by_id[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        where[by_id[r.doc_id] or ""].append(r.shard)
    return where


def test_whole_table(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = [tuple(r) for r in df.select("doc_id", "text").collect()]
    where = check(S.shard_rows(df).collect(), texts, 16)
    assert all(len(set(v)) == 1 for v in where.values() if len(v) <= len(texts) // 16)


def test_hot_group_and_no_singles(spark, docs_of, chunked):
    """A third of all rows are one text, all others come in pairs."""
    texts = [(i, "hot") for i in range(40)] + [(100 + i, f"pair {i // 2}") for i in range(80)]
    where = check(S.shard_rows(docs_of(texts), shards=6).collect(), texts, 6)
    assert len(set(where["hot"])) <= 3              # 40 rows, shards of 20
    cut = sum(len(set(v)) > 1 for t, v in where.items() if t != "hot")
    assert cut <= 8                                 # of 40; one in six starts whole


def test_edges(spark, docs_of):
    texts = [(1, None), (2, ""), (3, "é\n" * 50_000), (4, "a"), (5, "a")]
    where = check(S.shard_rows(docs_of(texts), shards=3).collect(), texts, 3)
    assert len(set(where[""])) == 1 and len(set(where["a"])) == 1
    same = docs_of([(7, "x")] * 6 + [(None, "y")])
    rows = S.shard_rows(same, shards=4).collect()
    assert Counter(r.doc_id for r in rows) == {7: 6, None: 1}
    assert sorted(Counter(r.shard for r in rows).values()) == [1, 2, 2, 2]
    assert S.shard_rows(same.limit(0)).collect() == []


def test_links_and_written_shards(spark, docs_of, tmp_path):
    """Links other than copies: chains of documents mostly stay together."""
    docs = docs_of([(i, f"text {i}") for i in range(120)])
    ids = {zlib.crc32(f"text {i}".encode()): i for i in range(120)}

    def members(nodes):
        node = {ids[r.text_crc32]: r.node for r in nodes.collect()}
        chain = [(node[i], node[i + 1]) for i in range(119) if i % 6 != 5]
        return S.link_groups(spark.createDataFrame(chain, "a long, b long"))

    out = S.write_shards(docs, str(tmp_path / "s"), shards=4, rounds=20, members=members)
    assert set(out.columns) == {*docs.columns, "shard", "slot"}
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == 120 and sorted(Counter(r.shard for r in rows.values()).values()) == [30] * 4
    cut = sum(rows[i].shard != rows[i + 1].shard for i in range(119) if i % 6 != 5)
    assert cut <= 25                                # of 100; 75 at random
    with pytest.raises(ValueError):
        S.write_shards(docs.withColumn("shard", docs.doc_id), str(tmp_path / "t"))


def test_quotas():
    # full shards exchange, also around a ring; nobody moves where nothing leaves
    ring = {(0, 1, 0): 5, (1, 2, 0): 3, (2, 0, 0): 9}
    assert S.quotas(ring, [10, 10, 10], [10, 10, 10]) == {(0, 1): 3, (1, 2): 3, (2, 0): 3}
    assert S.quotas({(0, 1, 0): 5}, [10, 10], [10, 10]) == {}
    # room for three: the highest gains
    assert S.quotas({(0, 2, 1): 5, (1, 2, 4): 2}, [10, 10, 7], [10, 10, 10]) == {(0, 2): 1, (1, 2): 2}
