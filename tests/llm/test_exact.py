from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from making import make  # noqa: F401

from voidage.llm import exact


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(-1 if i is None else i)
    out = []
    for i, text in rows:
        top = max(groups[text or ""])
        out.append((i, None if top < 0 else top, len(groups[text or ""]), (-1 if i is None else i) == top))
    return sorted(out, key=str)


ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "a "), (None, "q"), (None, "a"), (7, "x" * 300_000),
        (8, "x" * 300_000), (9, "ä"), (9, "ä"), (10, "é"), (11, "é")]


def test_classes_of_equal_texts(make):
    got = exact.exact_dedup(make(ROWS, "digest")).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)


def test_texts_that_share_a_digest_stay_apart(make):
    weak = lambda text: F.unhex(F.lpad(F.hex(F.length(text) % 2), 2, "0"))
    got = exact.exact_dedup(make(ROWS), weak).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS)
    kept = exact.keep_one(make(ROWS), weak).select("doc_id", "text").collect()
    assert len(kept) == len({t or "" for _, t in ROWS})


def test_one_row_of_each_class_stays_with_its_columns(make):
    docs = make(ROWS, "__x")
    kept = exact.keep_one(docs)
    assert kept.columns == docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in ROWS})


def test_empty_table(make):
    assert exact.exact_dedup(make([])).count() == 0
    assert exact.keep_one(make([])).count() == 0


def test_state_goes_on_where_it_ended(spark, tmp_path):
    schema = "digest binary, doc_id bigint, source_file string"
    put = lambda rows: spark.createDataFrame([(bytes([d]), i, "f") for d, i in rows], schema).coalesce(1).write.mode(
        "append").parquet(str(tmp_path / "in"))
    put([(1, 5), (2, 6)])
    state = lambda: {r.digest[0]: (r.retained.doc_id, r.n) for r in exact.run_stream(
        spark, str(tmp_path / "in"), schema, max_files=1, folder=str(tmp_path / "state")).collect()}
    assert state() == {1: (5, 1), 2: (6, 1)}
    put([(1, 9), (3, 1)])
    put([(1, 2)])
    assert state() == {1: (9, 3), 2: (6, 1), 3: (1, 1)}
