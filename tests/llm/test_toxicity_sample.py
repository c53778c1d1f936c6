"""What reaches the driver for training."""

from __future__ import annotations

from making import make  # noqa: F401

from voidage.llm import toxicity as T


def test_one_row_of_each_sampled_id(spark, make, monkeypatch):
    ids = [i for i in range(60) if i % 2 == 0]
    rows = [(i, f"text {i}") for i in ids] + [(2, f"other {k}") for k in range(200)]
    labels = [(i, 1, i % 4 // 2) for i in ids] + [(4, 1, 0), (4, 1, 1)]
    learned = {}
    monkeypatch.setattr(T, "fit", lambda texts, toxic: learned.update(texts=texts, toxic=list(toxic)))
    seen = []
    for order in (1, -1):
        docs = make(rows[::order]).repartition(5)
        T.train(docs, spark.createDataFrame(labels[::order], "doc_id long, quality int, toxic int"))
        seen.append((list(learned["texts"]), [int(x) for x in learned["toxic"]]))
    assert seen[0] == seen[1]
    known = [i for i in ids if not spark.range(1).select(T.held_out(T.F.lit(i))).first()[0]]
    assert len(seen[0][0]) == len(known)
    if 4 in known:
        assert dict(zip(*seen[0]))["text 4"] == 1
