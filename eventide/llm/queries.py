"""Registered queries of the operators in this package, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import (align, langid, license_scan, packing, prefix_trie, quality, secret_scan, sharding,
                          simhash, topk, url_filter, warc, winnow)
from eventide.llm.common import id_hash_mod, shared_path, small_batches

# The rules that op9 judges by.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_json() -> str:
    """The public byte-level BPE tokenizer, read on the driver."""
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def piece_model() -> bytes:
    """The public sentence-piece model, read on the driver."""
    import public_tokenizers
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def op1_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = id_hash_mod(F.col("doc_id"), 3) == 1
    known = _table(spark, sf_dir, "labels").filter(~held_out)
    model = quality.train(docs, known, label_col="quality")
    return quality.score(docs, model) \
        .select("doc_id", held_out.alias("held_out"), "score",
                (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.contamination(_table(spark, sf_dir, "documents"),
                                 _table(spark, sf_dir, "benchmark"), span=10, gram=5)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op3_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path, min_revisit=0)
    return warc.read_archives(spark, path, with_payload=False) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_license_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(_table(spark, sf_dir, "documents"))
    base = F.array_distinct(F.transform("base_places", lambda p: p["label"]))
    more = F.array_distinct(F.transform("spans", lambda s: s["label"]))
    best = F.array_max(F.transform("spans", lambda s: s["score"]))
    versions = F.transform(F.filter("spans", lambda s: s["version"].isNotNull()),
                           lambda s: F.concat_ws(" ", s["label"], s["version"]))
    return found.select(
        "doc_id", "n_words", F.size("base_places").cast("long").alias("n_base"),
        F.array_min(F.transform("base_places", lambda p: p["word"])).alias("first_word"),
        F.array_max(F.transform("base_places", lambda p: p["word"])).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"),
        F.array_join(F.array_sort(F.array_distinct(versions)), ",").alias("versions"))


def license_base_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op4 that edits do not touch, which SQL can express."""
    return op4_license_fuzzy(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def op5_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id", *[F.size(_of_kind(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def secret_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op5 that the measure does not touch, which SQL can express."""
    return op5_secret_novelty(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def _of_kind(kind: str):
    return F.filter("spans", lambda s: s["kind"] == kind)


def op6_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_json(), capacity=2048,
                        with_ids=False)


def op7_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = id_hash_mod(F.col("doc_id"), 4) == 2
    model = langid.train(docs.filter(~held_out))
    return langid.identify(docs.select("doc_id", "text"), model) \
        .select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_topk_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256) \
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op9_url_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_filter.judge(_table(spark, sf_dir, "pages"), rules)


def op10_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op11_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, sf_dir, "documents"), shards=16)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(_table(spark, sf_dir, "conversations"))
    rebuilt, convs = prefix_trie.share_openings(turns, every=20, longest=4)
    return prefix_trie.prefix_trie(rebuilt, convs)


def op13_shared_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(_table(spark, sf_dir, "documents"), tokenizer_json(), piece_model())


QUERIES = {
    "op1_quality_attention": op1_quality_attention,
    "op2_winnowing": op2_winnowing,
    "op3_warc_zstd": op3_warc_zstd,
    "op4_license_fuzzy": op4_license_fuzzy,
    "op5_secret_novelty": op5_secret_novelty,
    "op6_bounded_packing": op6_bounded_packing,
    "op7_language_bitmask": op7_language_bitmask,
    "op8_topk_postings": op8_topk_postings,
    "op9_url_bloom": op9_url_bloom,
    "op10_simhash_multi_index": op10_simhash_multi_index,
    "op11_label_propagation": op11_label_propagation,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_shared_cuts": op13_shared_cuts,
    "license_base_places": license_base_places,
    "secret_base_spans": secret_base_spans,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

# Queries without an entry here have no SQL form (learned models, XXH64
# votes, BPE ids, fuzzy and compressor spans, label propagation); tests/llm holds them against
# brute-force versions, round trips or held-out accuracy.
def _spans_sql(kind: str, pattern: str, least: int, group: int = 0) -> str:
    """Places of a pattern: the texts between its matches, summed up, give the starts."""
    return f"""SELECT doc_id, '{kind}' AS kind, first, first + length(m[i]) AS stop, g
  FROM (SELECT doc_id, i, m, list_sum(list_transform(range(1, i + 1), lambda j: length(s[j])))
               + coalesce(list_sum(list_transform(range(1, i), lambda j: length(m[j]))), 0) AS first,
               regexp_extract(m[i], '{pattern}', {group}) AS g
        FROM (SELECT doc_id, m, s, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS s FROM d)))
  WHERE length(g) >= {least}"""


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = (f"({'|'.join(_either(w) for w in ('password', 'passwd', 'secret', 'token'))}|{_either('api')}_?{_either('key')})"
           r"""[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)""")

ORACLE: dict[str, str] = {
    "license_base_places": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     p AS (SELECT doc_id, len(w) AS n_words,
                  list_filter(range(1, len(w)), lambda i: w[i] = 'apache' AND w[i + 1] = 'license') AS a,
                  list_filter(range(1, len(w) - 1), lambda i: w[i] = 'general' AND w[i + 1] = 'public'
                                                              AND w[i + 2] = 'license') AS g,
                  list_filter(range(1, len(w)), lambda i: w[i] = 'mit' AND w[i + 1] = 'license') AS m FROM d)
SELECT doc_id, n_words, len(a) + len(g) + len(m) AS n_base, list_min(a || g || m) - 1 AS first_word,
       list_max(a || g || m) - 1 AS last_word,
       concat_ws(',', CASE WHEN len(a) > 0 THEN 'apache' END, CASE WHEN len(g) > 0 THEN 'gpl' END,
                 CASE WHEN len(m) > 0 THEN 'mit' END) AS base_labels
FROM p""",
    "secret_base_spans": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     s AS ({_spans_sql('assign', _ASSIGN, 6, 2)}
           UNION ALL {_spans_sql('access', 'AKIA[A-Z0-9]+', 20)}
           UNION ALL {_spans_sql('hex', '[0-9a-f]+', 24)}),
     k AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
                  count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
                  string_agg(kind || ':' || first || ':' || stop, ','
                             ORDER BY first, list_position(['assign', 'access', 'hex'], kind)) AS spans
           FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256
FROM d LEFT JOIN k USING (doc_id)""",
    "op2_winnowing": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
     lens AS (SELECT DISTINCT least(10, len(w)) AS n FROM i WHERE len(w) > 0),
     iw AS (SELECT DISTINCT item_id, n, list_slice(w, p, p + n - 1) AS g
            FROM (SELECT item_id, w, least(10, len(w)) AS n,
                         unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
     dw AS (SELECT doc_id, n, p, list_slice(w, p, p + n - 1) AS g
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
                  FROM d, lens WHERE len(w) >= n)),
     m AS (SELECT dw.doc_id, dw.p, dw.n, iw.item_id FROM dw JOIN iw USING (n, g)),
     h AS (SELECT doc_id, count(DISTINCT q) AS n_hit
           FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
     t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op3_warc_zstd": """
WITH p AS (SELECT page_id, coalesce(html, '') AS b FROM pages),
     x AS (SELECT page_id, strlen(b) AS payload_bytes, sha1(b) AS h, max(page_id) OVER (PARTITION BY b) AS top FROM p),
     bits AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda k: ['0000','0001','0010','0011','0100','0101',
                '0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', h[k])]),
                '') AS z FROM x)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(
           list_transform(range(1, 6), lambda j: CAST(z[5 * k + j] AS BIGINT) * CAST(power(2, 5 - j) AS BIGINT)))::BIGINT]), '')
           AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM bits""",
    "op8_topk_postings": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id,
                  CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op9_url_bloom": f"""
WITH rules(rule_host, rule_path, v) AS (VALUES {', '.join(str(r) for r in URL_RULES)}),
     u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
     s AS (SELECT row_number() OVER () AS i, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
     m AS (SELECT s.i, rule_host || rule_path AS rule, v,
                  row_number() OVER (PARTITION BY s.i ORDER BY length(rule_host || rule_path) DESC) AS k
           FROM s JOIN rules ON starts_with(path, rule_path)
                AND (host = rule_host OR ends_with(host, '.' || rule_host)))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM s LEFT JOIN m ON s.i = m.i AND m.k = 1""",
    "op12_prefix_trie": r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS p
           FROM conversations WHERE conv_id IS NOT NULL),
     convs AS (SELECT c, c - c % 20 AS b, xor(list_reduce(list_prepend(4294967295::BIGINT,
                        list_transform(range(1, length(s) + 1), lambda i: ord(s[i])::BIGINT)),
                        lambda crc, o: list_reduce([xor(crc, o), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                            lambda x, z: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 4 AS h
               FROM (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s FROM t)),
     r AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY side, p) AS d, role, text
           FROM (SELECT convs.c, 0 AS side, p, role, text FROM convs JOIN t ON t.c = convs.b AND p <= h
                 UNION ALL SELECT t.c, 1, p, role, text FROM t JOIN convs USING (c) WHERE p > h)),
     k AS (SELECT c, d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
                  md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
                      OVER (PARTITION BY c ORDER BY d)) AS k FROM r),
     path AS (SELECT c, d, words, k, coalesce(lag(k) OVER (PARTITION BY c ORDER BY d), '') AS up FROM k
              UNION ALL SELECT c, 0, 0, '', NULL FROM convs),
     node AS (SELECT k, d AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                     any_value(up) AS up FROM path GROUP BY k, d),
     kids AS (SELECT up AS k, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY up),
     sub AS (SELECT p.k, sum((n_convs - 1) * node.words) AS saved, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END) AS leaves
             FROM node LEFT JOIN kids USING (k) JOIN path p ON p.c = node.conv_id AND p.d <= node.depth GROUP BY p.k),
     ends AS (SELECT k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
              FROM (SELECT c, arg_max(k, d) AS k FROM path GROUP BY c) GROUP BY k)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, node.n_convs,
       CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node LEFT JOIN node up ON up.k = node.up LEFT JOIN kids ON kids.k = node.k JOIN sub ON sub.k = node.k
     LEFT JOIN ends ON ends.k = node.k""",
}
