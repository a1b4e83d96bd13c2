import random

import corpus_pipeline as cp
import pytest
from tokenizers import Tokenizer

from eventide.llm import secret_scan
from eventide.llm.queries import QUERIES, tokenizer_json

from . import test_packing, test_simhash, test_winnow
from .helpers import lower

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"aa": "alpha beta gamma delta nuance orbit lamp stone river paper".split(),
         "bb": "zwölf kühe über grüße straße hügel möwe jäger föhn größe".split()}


def text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "s", "n", "te"]) for _ in range(n))


def documents():
    rng = random.Random(11)
    rows = []
    for i in range(60):
        lang = ("aa", "bb")[i % 2]
        rows.append((i, text(rng, lang, rng.randint(30, 120)), lang))
    items = [(1, text(rng, "aa", 25)), (2, text(rng, "bb", 15)), (3, "short item"), (4, None)]
    rows += [(100, rows[4][1], "aa"), (101, rows[4][1] + " more", "aa"), (100, rows[4][1], "aa"),
             (102, text(rng, "aa", 20) + " " + items[0][1][10:] + " " + text(rng, "aa", 20), "aa"),
             (103, text(rng, "bb", 40) + ", Short ITEM! " + text(rng, "bb", 10), "bb"),
             (104, None, "aa"), (105, "", None), (106, "12 34 !!", "aa"), (107, "ωψχ φυτ", None),
             (108, text(rng, "aa", 30) + " password=hunter22x and " + text(rng, "aa", 30), "aa"),
             (None, text(rng, "bb", 50), "bb"), (109, text(rng, "aa", 8000), "aa")]
    return [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], items


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage, written and read again as run() does."""
    d = str(tmp_path_factory.mktemp("corpus"))
    rows, items = documents()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), [rows]
    for name, stage in cp.STAGES:
        result = stage(spark, docs, d)
        if name != "pack":
            assert result.columns == docs.columns
        result.write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        out.append([r if name == "pack" else tuple(r) for r in docs.collect()])
    return d, items, out


def test_order_of_the_stages():
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_dedup", "decontaminate", "redact_secrets", "pack"]


def test_language_stage_drops_what_has_no_language(stages):
    _, _, out = stages
    gone = {r[0] for r in out[0]} - {r[0] for r in out[1]}
    assert gone == {104, 105, 106, 107} and len(out[1]) == len(out[0]) - 4


def test_dedup_stage_keeps_one_of_each_group(stages):
    _, _, out = stages
    fps = [test_simhash.brute_fingerprint(r[1]) for r in out[1]]
    root = test_simhash.brute_components(fps, 3)
    best = {}
    for r, f in zip(out[1], fps):
        key = (r[0] is None, r[0] or 0)
        best[root[f]] = min(best.get(root[f], (key, r)), (key, r), key=lambda x: x[0])
    assert sorted(out[2], key=repr) == sorted((r for _, r in best.values()), key=repr)
    assert {100, 101} & {r[0] for r in out[2]} <= {101}


def test_decontamination_stage_drops_hit_documents_only(stages):
    _, items, out = stages
    hit = test_winnow.brute([(k, r[1]) for k, r in enumerate(out[2])], items)
    want = [out[2][k] for k, _, n, _ in hit if not n]
    assert sorted(out[3], key=repr) == sorted(want, key=repr) and {102, 103}.isdisjoint(r[0] for r in out[3])


def test_secret_stage_masks_and_keeps_every_document(stages):
    _, _, out = stages
    novelty = secret_scan.Novelty()
    want = []
    for i, t, lang, source, n in out[3]:
        new = secret_scan.mask(t, secret_scan.find_secrets(t, novelty), "[SECRET]")
        want.append((i, new, lang, source, n if new == t else len(new)))
    assert sorted(out[4], key=repr) == sorted(want, key=repr)
    assert "password=[SECRET] and" in next(r[1] for r in out[4] if r[0] == 108)


def test_packed_sequences_hold_every_token(stages):
    _, _, out = stages
    tok = Tokenizer.from_str(tokenizer_json())
    want = {r[0]: test_packing.ids_of(tok, r[1]) for r in out[4]}
    assert len(want) == len(out[4]) and test_packing.check(out[5], want, 2048) == 0


def test_run_gives_the_same_rows(spark, stages):
    d, _, out = stages
    tokens = sorted((r.doc_id or -1, r.start, r.length, r.doc_tokens) for r in out[5])
    got = cp.run(spark, d)
    assert sum(t[2] for t in tokens) == got.agg({"length": "sum"}).first()[0]
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == {r.doc_id for r in out[5]}


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert lower("ÄB c") == "Äb c"


def test_column_names_and_types_of_a_caller(spark, docs_of):
    """Helper names that the caller has too, names with signs, maps, repeated rows."""
    from pyspark.sql import functions as F
    docs = docs_of([(1, "the quick brown fox jumps over the dog"), (1, "the quick brown fox jumps over the dog"),
                    (2, "a completely different text about other things"), (3, None)])
    for c in ("_kept_id", "_kept_hash", "_bad_id", "_bad_hash", "_language", "_language_score",
              "_language_coverage", "_ROW", "a`b", "x.y z"):
        docs = docs.withColumn(c, F.lit("mine"))
    docs = docs.withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    sf = "/root/testdata/sf0.001"
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert {r["_language"] for r in out.collect()} <= {"mine"}, name
    assert sorted(r.doc_id for r in cp.near_dedup(spark, docs, sf).collect()) == [1, 2, 3]
