import random

import numpy as np

import corpus_pipeline
from strata.llm.common import stage, table

SMALL = "/root/testdata/sf0.001"


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SMALL, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, fn in corpus_pipeline.STAGES[:-1]:
        docs = stage(fn(spark, docs, SMALL), "test-pipeline")
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in docs.collect())
    ends = np.cumsum([r.n_tokens for r in sorted(last, key=lambda r: r.doc_id)])
    assert [r.start for r in sorted(last, key=lambda r: r.doc_id)] == [0, *ends[:-1].tolist()]


def test_pipeline_run_over_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SMALL, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def _shingles(text):
    w = text.split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def test_near_dedup_stage_links_from_four_fifths(spark):
    """Copies of similarity 0.70 to 0.95 against brute force at 0.8."""
    r = random.Random(8)
    rows = []
    for i in range(40):
        w = [f"w{r.randrange(10**6)}" for _ in range(240)]
        rows.append((2 * i, " ".join(w)))
        for at in range(0, 6 * (2 + i % 7), 6):
            w[at] = "changed"
        rows.append((2 * i + 1, " ".join(w)))
    alike = [len(a & b) / len(a | b) for a, b in ((_shingles(rows[k][1]), _shingles(rows[k + 1][1])) for k in range(0, 80, 2))]
    assert sum(0.8 <= x < 0.85 for x in alike) > 5 and sum(x < 0.8 for x in alike) > 5
    want = sorted([i for i, _ in rows if i % 2 == 0] + [2 * k + 1 for k, x in enumerate(alike) if x < 0.8])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(x.doc_id for x in corpus_pipeline.distinct(spark, docs, SMALL).collect()) == want
