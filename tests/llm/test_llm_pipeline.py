"""The pipeline against its stages done by hand on a small table."""

import public_tokenizers
import tiktoken

import corpus_pipeline
from llm_setup import few_partitions  # noqa: F401
from reelsight.llm import bpe, line_quality, mixing, secret_scan, simhash
from test_llm_queries import DOCS, odd_docs

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
REF = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mix", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run(spark, tmp_path):
    rows = odd_docs()
    rows.append((300, "A leak: " + " ".join(f"uva{'b' * (i % 7)}{'c' * (i // 7)}" for i in range(80)) + ' token = "0123456789abcdef0123456789abcdef01234567"',
                 "en", "a", 5, 1, "h", 2, "r"))
    df = spark.createDataFrame(rows, DOCS)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = {r.doc_id for r in line_quality.judge(df).collect() if r.kept}
    clean = line_quality.clean(df)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == kept
    near = simhash.near_duplicates(clean).collect()
    first = {r.component_id for r in near}
    one = simhash.one_of_each(clean)
    assert sorted(r.doc_id for r in one.collect() if r.doc_id is not None) == sorted(x for x in first if x is not None)
    safe = secret_scan.redact(one, secret_scan.train(secret_scan.labelled_findings(spark)))
    texts = {r.doc_id: r.text for r in safe.collect()}
    assert texts[300].endswith('token = "[SECRET]"')
    times = {r.doc_id: r.copies for r in mixing.plan(safe).collect() if r.copies}
    have = {}
    for r in got:
        assert list(r.token_ids) == REF.encode_ordinary(texts[r.doc_id]) and r.round_trip
        have[r.doc_id] = have.get(r.doc_id, 0) + 1
    assert have == times and times


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
