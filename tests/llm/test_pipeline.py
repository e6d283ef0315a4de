"""The stages one by one on the given tables, and the registered queries."""

import hashlib

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from daybook.llm import bpe, pii, quality
from daybook.llm.common import documents, settle
from daybook.llm.queries import ORACLES, QUERIES
from tests.llm import tables
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_pii import base as brute_pii
from tests.llm.test_simhash import brute_components, brute_fingerprint
from workload.compare import connect

SF_DIR = "/root/testdata/sf0.001"


def test_run_equals_the_stages_by_hand(spark):
    """Each stage against brute force on what the one before kept."""
    docs = documents(spark, SF_DIR)
    net = quality.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    scores = net.score([t.encode() for t in rows.values()])
    rows = {i: t for (i, t), s in zip(rows.items(), scores, strict=True) if s >= quality.ACCEPTED}
    prints = {i: brute_fingerprint(t) for i, t in rows.items()}
    whole = brute_components(set(prints.values()))
    rows = {i: t for i, t in rows.items() if i == min(j for j in rows if prints[j] in whole[prints[i]])}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    rows = {i: t for i, t in rows.items() if not brute_hits(t, items)[-1]}
    left = docs.where(docs["doc_id"].isin(list(rows)))
    clean = {r["doc_id"]: r["text"] for r in pii.redact(left).collect()}
    assert not any(brute_pii(t) for t in clean.values())
    library = Tokenizer.from_file(bpe.default_path())
    library.no_truncation()
    expected = []
    for i, t in clean.items():
        ids = library.encode(t, add_special_tokens=False).ids
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert tables.rows(corpus_pipeline.run(spark, SF_DIR)) == sorted(expected, key=str)


def test_stages_take_awkward_rows_and_keep_the_columns(spark):
    docs = tables.documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = settle(stage(spark, docs, SF_DIR), name)
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
        assert stage(spark, tables.empty(spark), SF_DIR).count() == 0
        docs = kept
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count()


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    result = connect(SF_DIR).execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(map(tuple, QUERIES[name](spark, SF_DIR).select(*names).collect())) == sorted(result.fetchall())


def test_all_are_registered():
    found = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(found)
    assert len(corpus_pipeline.STAGES) == 5
