"""The pipeline against a brute-force version, and the registration."""

import hashlib

import __spark_entry__ as E
import corpus_pipeline as C
import numpy as np
import public_tokenizers as P
import tiktoken
from brute import DOCS, SF, cleaned, components, docs_frame, table

from tillroll.llm import bpe, quality_model


def test_run_equals_brute_force(spark):
    docs = table(spark, "documents")
    good = {r.doc_id for r in quality_model.quality_scores(docs, table(spark, "labels")).where("predicted = 1").collect()}
    rows = [(r.doc_id, *cleaned(r.text)) for r in docs.collect() if r.doc_id in good]
    rows = [(i, t) for i, kept, t in rows if kept]
    first = components(rows)
    exact = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = {}
    for i, t in rows:
        if first[i] == i:
            ids = exact.encode_ordinary(t)
            want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in C.run(spark, SF).collect()}
    assert got == want and len(got) > 100


def test_stages_on_odd_rows(spark, scratch):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    long_rows = [(i, " ".join(f"u{i}x{k}" for k in range(80)) + ".") for i in (50, 51, None)]
    for rows in (DOCS + long_rows, []):
        df = docs_frame(spark, rows or DOCS).limit(len(rows) if rows else 0)
        for _, stage in C.STAGES[1:-1]:
            out = stage(spark, df, scratch)
            assert out.columns == df.columns and out.dtypes == df.dtypes
            df = out
        assert {r.doc_id for r in df.collect()} == ({5, 50, 51, None} if rows else set()) or rows
        assert C.STAGES[-1][1](spark, df, scratch).count() == df.count()


def test_first_stage_keeps_columns(spark):
    df = table(spark, "documents")
    out = C.keep_quality(spark, df, SF)
    assert out.columns == df.columns and 0 < out.count() < df.count()


def test_registered():
    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert {"op1_quality_rules", "op2_source_mix", "op6_near_dups", "op9_warc"} <= set(E.oracle_sql())
