"""The pipeline on a small folder of tables: every stage's decisions against plain Python."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.conftest import prose
from tests.llm.test_decontamination import words
from tests.llm.test_near_duplicates import expected as expected_classes
from tests.llm.test_repeats import expected as expected_repeats


def test_stages(spark, tmp_path):
    rows, labels = [], []
    for k in range(160):
        text = prose(k, 60)
        if k % 4 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        rows.append((k, text, "en", "s", len(text)))
        labels.append((k, int(k % 4 != 0), 0))
    passage, item = prose(500, 20), prose(501, 25)
    rows += [(200 + k, prose(600 + k, 50) + " " + passage, "en", "s", 1) for k in range(4)]
    rows += [(210, rows[1][1], "en", "s", 1), (211, prose(602, 50) + " " + item, "en", "s", 1), (212, None, "en", "s", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality":
            assert {k for k in before if k < 160 and k % 4} <= set(after) and not any(k < 160 and k % 4 == 0 for k in after)
        elif name == "near_duplicates":
            assert set(after) == {c for _, c in expected_classes(sorted(before.items()))}
        elif name == "repeats":
            sizes = {i: n - gone for i, n, gone, *_ in expected_repeats(list(before.items()))}
            assert {i: len((t or "").encode()) for i, t in after.items()} == sizes
        else:
            assert set(after) == {i for i, t in before.items() if b" ".join(words(item)[:10]) not in b" ".join(words(t))}
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == set(before)
