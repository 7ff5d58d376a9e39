"""Each pipeline stage against a plain computation on its own input."""

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from routelytics.llm import byte_bpe, decontaminate, pii, quality_rules

from conftest import SF_TINY
from llm_brute import components_by_all_pairs

ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                        mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    # a table with a leak, copies, odd rows and columns of its own
    bench = [r.text for r in spark.read.parquet(f"{SF_TINY}/benchmark.parquet").collect()]
    first = docs.orderBy("doc_id").first()
    extra = spark.createDataFrame(
        [(90001, f"Here it is: {bench[0]} and more words to be long enough for rules", "en", "src1", 1),
         (90002, first.text + " tail", first.lang, first.source, 1), (90003, None, None, None, None),
         (None, "a row without an id but with quite enough words in it to stay", "en", "src1", 1),
         (90004, "write to someone@site.example.org about ten or more words that are clean here", "en", "src1", 1)], docs.schema)
    rows = docs.unionByName(extra).selectExpr("*", "1 AS kept", "'x' AS row", "doc_id AS component_id")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "decontaminate", "pii", "byte_bpe"]

    out = corpus_pipeline.quality(spark, rows, SF_TINY)
    want = {r.doc_id for r in quality_rules.digest(rows).collect() if r.kept}
    assert out.columns == rows.columns and set(texts(out)) == want and 90003 not in want and 90001 in want

    before, rows = rows, spark.createDataFrame(out.collect(), rows.schema)
    out = corpus_pipeline.dedup(spark, rows, SF_TINY)
    comp = components_by_all_pairs([(r.doc_id, r.text) for r in rows.collect() if r.doc_id is not None], 5)
    assert out.columns == before.columns
    assert set(texts(out)) == {i for i, c in comp.items() if c == i} | {None} and 90002 not in texts(out)

    rows = spark.createDataFrame(out.collect(), rows.schema)
    out = corpus_pipeline.decontaminated(spark, rows, SF_TINY)
    plain = lambda t: "".join(map(chr, decontaminate.Normaliser()(t)[0]))
    items = [plain(b) for b in bench]
    exact = {i for i, t in texts(rows).items() if any(b in plain(t) for b in items)}
    assert out.columns == before.columns and 90001 in exact
    assert not exact & set(texts(out)) and None in texts(out) and 90004 in texts(out)

    rows = spark.createDataFrame(out.collect(), rows.schema)
    out = corpus_pipeline.redacted(spark, rows, SF_TINY)
    find = pii._proposer(pii.PiiParams())
    got = texts(out)
    assert out.columns == before.columns and got[90004].startswith("write to <EMAIL> about")
    for i, t in texts(rows).items():
        assert (got[i] == t) == (not find(t)) and not find(got[i])

    rows = spark.createDataFrame(out.collect(), rows.schema)
    out = corpus_pipeline.encoded(spark, rows, SF_TINY)
    assert {r.doc_id: list(r.ids) for r in out.collect()} == {i: ENC.encode_ordinary(t) for i, t in got.items()}


def test_run_equals_the_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_TINY)
        docs = spark.createDataFrame(out.collect(), out.schema)
    key = lambda r: r.doc_id
    got = sorted(corpus_pipeline.run(spark, SF_TINY).collect(), key=key)
    assert got and got == sorted(docs.collect(), key=key)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_TINY)
    assert docs.collect() == []
