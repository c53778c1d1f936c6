from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from making import MEDIUM, make  # noqa: F401

from voidage.llm import near
from voidage.llm.common import components, documents


def shingles(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, percent=85):
    """Smallest reachable id of each; candidates by any common shingle, so nothing is missed."""
    sets = [shingles(t) for _, t in rows]
    owner = list(range(len(rows)))

    def find(x):
        while owner[x] != x:
            owner[x] = owner[owner[x]]
            x = owner[x]
        return x

    classes = defaultdict(list)
    for k, s in enumerate(sets):
        if s:
            classes[s].append(k)
    for members in classes.values():
        for k in members:
            owner[find(k)] = find(members[0])
    heads = [m[0] for m in classes.values()]
    by = defaultdict(list)
    for k in heads:
        for s in sets[k]:
            by[s].append(k)
    seen = set()
    for k in heads:
        for other in {o for s in sets[k] for o in by[s] if o < k and len(by[s]) < 3000}:
            if (k, other) in seen or min(len(sets[k]), len(sets[other])) * 100 < percent * max(len(sets[k]), len(sets[other])):
                continue
            common = len(sets[k] & sets[other])
            if 100 * common >= percent * (len(sets[k]) + len(sets[other]) - common):
                owner[find(k)] = find(other)
    least = {}
    for k, (i, _) in enumerate(rows):
        root = find(k)
        least[root] = min(i, least.get(root, i))
    return sorted((i, len(sets[k]), least[find(k)], least[find(k)] == i) for k, (i, _) in enumerate(rows))


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def edited(rng, words, share):
    out = list(words)
    for _ in range(max(1, int(len(out) * share))):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def test_documents(spark):
    docs = documents(spark, MEDIUM)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(near.near_duplicates(docs)) == brute(rows)


def test_groups_around_the_threshold(spark, make):
    rng = random.Random(4)
    rows = []
    for group in range(12):
        base = [f"b{group}_{k}" for k in range(rng.choice([12, 60, 200]))]
        for share in [0.005, 0.01, 0.02, 0.025, 0.03, 0.04, 0.06] * 4:
            rows.append(edited(rng, base, share))
    rng.shuffle(rows)
    rows += ["", None, " \n", "A", "a", "a b", "A B", "a b c", "Ä b c", "ä b c", "x " * 50_000, "x " * 40_000]
    rows = list(enumerate(rows))
    assert result(near.near_duplicates(make(rows, "digest").repartition(5))) == brute(rows)


def test_a_template_of_many_and_a_hot_group(spark, make):
    """Many texts a little below the threshold, among them pairs above it, and a third of all rows near copies."""
    rng = random.Random(6)
    template = [f"t{k}" for k in range(100)]
    rows = [edited(rng, template, 0.08) for _ in range(250)]
    rows += [edited(rng, text.split(), 0.01) for text in rows[:40]]
    hot = [f"h{k}" for k in range(150)]
    rows += [edited(rng, hot, 0.01) for _ in range(300)] + [" ".join(hot)] * 200
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    assert result(near.near_duplicates(make(rows))) == brute(rows)


def test_repeated_and_missing_ids(spark, make):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(5, text), (5, text), (3, text + " z"), (None, text), (9, "other words here"), (5, "other words here"), (None, None)]
    docs = make(rows, "text_hash")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near.near_duplicates(docs).collect() if r.doc_id is not None)
    assert got == [(3, 3, True), (5, 3, False), (5, 3, False), (5, 5, True), (9, 5, False)]
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, (r.text or "")[:5]) for r in kept.collect()) == [(-1, ""), (-1, "w0 w1"), (3, "w0 w1"), (5, "other")]


def test_empty_table(make):
    assert near.near_duplicates(make([])).count() == 0
    assert near.keep_one(make([])).count() == 0
    assert near.near_duplicates(make(["", None])).count() == 2


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    n = 60
    edges = [(k, k + 1) for k in range(25)] + [(30, k) for k in range(31, 45)] + [(rng.randrange(45, n), rng.randrange(45, n)) for _ in range(9)]
    names = list(range(n))
    rng.shuffle(names)
    edges = [(names[a], names[b]) for a, b in edges if a != b]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    owner = {x: x for e in edges for x in e}
    for _ in range(n):
        for a, b in edges:
            owner[a] = owner[b] = min(owner[a], owner[b])
    assert got == owner
