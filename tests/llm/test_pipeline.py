from __future__ import annotations

import corpus_pipeline
import pytest
from making import MEDIUM
from test_near import brute as near_brute
from test_near import shingles
from test_packing import brute as pieces_brute
from test_packing import fits

from voidage.llm import pseudonyms, toxicity
from voidage.llm.common import stored


def near_five(rows):
    """The ids that stay; only the width and the share differ from the operator's own test."""
    import test_near

    before = test_near.shingles
    test_near.shingles = lambda text, width=5: shingles(text, 5)
    try:
        return {i for i, _, _, kept in near_brute(rows, 80) if kept}
    finally:
        test_near.shingles = before


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, current, MEDIUM))
        assert after.columns == columns
        got = {r.doc_id: r.text for r in after.collect()}
        if name == "toxicity":
            model = toxicity.train(docs, spark.read.parquet(f"{MEDIUM}/labels.parquet"))
            scorer = toxicity.Scorer(model)
            want = {i: t for i, t in rows.items() if scorer.score([t or ""])[0][0] < 0.5}
        elif name == "exact dedup":
            last = {t or "": i for i, t in sorted(rows.items())}
            want = {i: t for i, t in rows.items() if last[t or ""] == i}
        elif name == "minhash near-dedup":
            stay = near_five(sorted(rows.items()))
            want = {i: t for i, t in rows.items() if i in stay}
        else:
            from test_pseudonyms import ANY
            import test_pseudonyms

            test_pseudonyms.KEY, key = pseudonyms.DEFAULT_KEY, test_pseudonyms.KEY
            want = {i: t and ANY.sub(lambda m: test_pseudonyms.brute(m.group()), t) for i, t in rows.items()}
            test_pseudonyms.KEY = key
            assert sum(want[i] != rows[i] for i in rows) > 20
            assert all(r.n_chars == len(r.text) for r in after.collect() if r.text is not None)
        assert got == want, name
        current, rows = after, got
    packed = corpus_pipeline.STAGES[-1][1](spark, current, MEDIUM).collect()
    pieces = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    assert pieces == sorted((i, *p) for i, t in rows.items() for p in pieces_brute(t, 4096))
    total = sum(r.length for r in packed)
    assert fits(packed, 4096) <= -(-total // 4096) * 1.02 + 1


def test_run_is_the_stages(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, toxic int, kept boolean"
    rows = [(i, f"some words of document {i} " * 3, None, None, None, 0, True) for i in range(6)] + [(9, None, None, None, 3, 1, False)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in out) == [0, 1, 2, 3, 4, 5, 9]


@pytest.mark.parametrize("n", [0])
def test_empty_table(spark, tmp_path, n):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(None, None, None, None, None)] * n, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == n
