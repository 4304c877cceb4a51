"""The pipeline against plain versions of its stages, stage by stage."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from kgloom.llm import langid, toxicity  # noqa: E402
from kgloom.session import materialized  # noqa: E402

from .test_bpe_packing import ids_of  # noqa: E402
from .test_simhash import fingerprint, roots  # noqa: E402
from .test_substring import brute  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are missing")


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    results = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = materialized(stage(spark, docs, SF_DIR), f"stage-{i}")
        results.append((before, docs))
        if i < 4:
            assert docs.columns == columns, name
    (whole, known), (_, clean), (_, single), (_, cut), (_, packed) = results

    judged = langid.predict(whole, langid.learned(whole))
    assert rows_of(known) == rows_of(judged.where("lang_pred <> 'und' and score >= 0.5").select(columns))

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    judged = toxicity.predict(known, toxicity.learned(known, labels))
    assert rows_of(clean) == rows_of(judged.where("predicted = 0").select(columns))

    before = clean.collect()
    low = {}
    for r, g in zip(before, roots([fingerprint(r.text) for r in before])):
        low[g] = min(low.get(g, r.doc_id), r.doc_id)
    assert rows_of(single) == Counter(tuple(r) for r in before if r.doc_id in low.values())

    before = single.collect()
    want = Counter()
    for r, (n, gone, kept) in zip(before, brute([r.text for r in before], 35)):
        if gone < n:
            want[tuple(r) if not gone else (r.doc_id, kept, r.lang, r.source, len(kept))] += 1
    assert rows_of(cut) == want

    totals = Counter()
    for p in packed.collect():
        totals[p.doc_id] += p.length
    assert totals == Counter({r.doc_id: len(ids_of(r.text)) + 1 for r in cut.collect()})


def test_run_and_odd_tables(spark, edge_docs, no_docs, tmp_path):
    labels = spark.createDataFrame([(4, 0, 1)], "doc_id long, quality int, toxic int")
    for name, docs in (("edge", edge_docs), ("none", no_docs)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/edge").count() > 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
