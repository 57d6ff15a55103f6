"""The registered queries against their SQL, and the pipeline stage by stage."""

import hashlib
import re

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from recurra.llm.common import table
from recurra.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    con = duckdb.connect()
    for view in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{SF}/{view}.parquet')")
    con.execute(ORACLES[name])
    names = [d[0] for d in con.description]
    assert sorted(names) == sorted(df.columns)
    order = [df.columns.index(n) for n in names]
    assert sorted(repr([r[i] for i in order]) for r in got) == sorted(repr(list(r)) for r in con.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs_over_every_row(spark, name):
    df = QUERIES[name](spark, SF)
    n = df.count()
    if name in ("op8_license_scan", "op11_spelling_variants"):
        assert n > 0
    else:
        source = "pages" if name == "op9_url_filter" else "documents"
        assert n == table(spark, SF, source).count()


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_pipeline_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "exact_dedup", "near_dedup", "mix", "bpe"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "bpe":
            assert after.columns == columns
        kept[name] = after.collect()
        docs = after
    texts = [norm(r.text) for r in kept["exact_dedup"]]
    assert len(texts) == len(set(texts)) == len({norm(r.text) for r in kept["quality_rules"]})
    near = {r.doc_id for r in kept["near_dedup"]}
    assert near <= {r.doc_id for r in kept["exact_dedup"]}
    assert {r.doc_id for r in kept["mix"]} <= near
    assert len(kept["bpe"]) == len(kept["mix"])
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lib.no_truncation()
    lib.no_padding()
    by_id = {r.doc_id: r.text for r in kept["mix"]}
    for r in kept["bpe"]:
        ids = lib.encode(by_id[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pipeline_run_is_the_stages(spark):
    result = corpus_pipeline.run(spark, SF)
    assert result.filter(F.col("n_tokens") < 1).count() == 0


def test_pipeline_on_odd_documents(spark):
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "few words", None, None, 3)],
        table(spark, SF, "documents").schema)
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
