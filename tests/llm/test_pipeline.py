import re
import shutil
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lakemoor.llm import quality, toxicity
from lakemoor.llm.queries import QUERIES
from lakemoor.llm.shared import materialise

SF = "/root/testdata/sf0.001"


def test_registered():
    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5


def test_stages(spark):
    from test_dedup import brute

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect() if r.predicted}
    after = materialise(corpus_pipeline.drop_toxic(spark, docs, SF), "t")
    assert after.columns == columns and {r.doc_id for r in after.collect()} == before.keys() - toxic
    good = {r.doc_id for r in quality.score(after, quality.fit(after, labels)).collect() if r.selected}
    docs = materialise(corpus_pipeline.drop_poor(spark, after, SF), "t")
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == good
    first = {}
    for i in sorted(good):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i]), i)
    docs = materialise(corpus_pipeline.drop_copies(spark, docs, SF), "t")
    assert docs.columns == columns and sorted(r.doc_id for r in docs.collect()) == sorted(first.values())
    want = {c for _, c, _ in brute([(i, before[i]) for i in first.values()])}
    docs = materialise(corpus_pipeline.drop_near_copies(spark, docs, SF), "t")
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == want
    packed = corpus_pipeline.pack_sequences(spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == want
    assert Counter(tuple(r)[:5] for r in corpus_pipeline.run(spark, SF).collect()) == Counter(tuple(r)[:5] for r in packed)


@pytest.mark.parametrize("name", ["op6_toxicity", "op7_quality"])
def test_contract_rows(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    ids = pq.read_table(f"{SF}/documents.parquet").column("doc_id").to_pylist()
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    if name == "op6_toxicity":
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in rows)


def test_nulls_and_empty_tables(spark, tmp_path, frame, odd_docs):
    rows = [(i, t if len(t or "") < 10000 else t[:10000]) for i, t in odd_docs]
    shape = lambda df: df.selectExpr("doc_id", "text", "cast(null as string) lang", "cast(null as string) source", "cast(null as bigint) n_chars")
    for name, data in (("full", rows), ("empty", [])):
        shape(frame(data)).write.parquet(str(tmp_path / name / "documents.parquet"))
        shutil.copy(f"{SF}/labels.parquet", tmp_path / name)
        got = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert bool(got) == bool(data)
