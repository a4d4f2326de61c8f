"""The pipeline's stages, each against what its operator decides."""

import hashlib
from collections import Counter

import corpus_pipeline
from quantspark.llm import bpe, secrets, simhash, toxicity
from quantspark.llm.common import read, stage

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    import public_tokenizers
    import tiktoken
    docs = read(spark, SF, "documents")
    columns = docs.columns
    outs = []
    for name, step in corpus_pipeline.STAGES:
        outs.append(stage(step(spark, outs[-1] if outs else docs, SF), "test"))
        assert len(outs) == len(corpus_pipeline.STAGES) or outs[-1].columns == columns, name
    clean, single, masked, mixed, last = outs
    verdict = {r.doc_id: r.predicted for r in toxicity.classify(docs, read(spark, SF, "labels")).collect()}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, p in verdict.items() if p == 0)
    groups = {r.component_id for r in simhash.near_duplicates(clean).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(groups)
    found = {r.doc_id: len(r.spans) for r in secrets.scan(single).collect()}
    before, after = ({r.doc_id: r.text for r in x.collect()} for x in (single, masked))
    assert before.keys() == after.keys() and all((before[i] != after[i]) == (found[i] > 0) for i in before)
    rows = mixed.collect()
    assert max(Counter(r.doc_id for r in rows).values()) <= 3 and all(after[r.doc_id].startswith(r.text) for r in rows)
    encoding = tiktoken.Encoding("r", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.vocabulary_path()), special_tokens={})
    want = Counter((r.doc_id, len(encoding.encode_ordinary(r.text)), hashlib.sha256(r.text.encode()).hexdigest()) for r in rows)
    assert Counter((r.doc_id, r.n_tokens, r.decoded_sha256) for r in last.collect()) == want


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_odd_rows_pass_every_stage(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars int, fp string, row long"
    rows = [(1, None, "en", "a", None, "x", 1), (None, None, None, None, None, None, None), (2, "", "en", None, 0, "x", 1),
            (3, "one two three", "en", "a", 13, "x", 1), (3, "one two three", "en", "a", 13, "x", 1)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for _, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, str(tmp_path)), "odd")
        assert [r.doc_id for r in docs.collect()] == ([3] if table else [])
