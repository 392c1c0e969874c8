"""The near-dedup stage of the pipeline against brute force."""

import random

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string"


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))) if words else frozenset()


def classes(rows, percent):
    """Numbers of the rows, by the first row of their class."""
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(sets):
        for j, b in enumerate(sets[:n]):
            if a and 100 * len(a & b) >= percent * len(a | b):
                p, q = root(n), root(j)
                parent[max(p, q)] = min(p, q)
    out = {}
    for n in range(len(rows)):
        out.setdefault(root(n), []).append(n)
    return out


def test_stage_removes_copies_from_four_fifths_on(spark):
    random.seed(8)
    rows = []
    for group in range(40):
        words = [f"g{group}w{k}" for k in range(104)]
        rows.append((2 * group, " ".join(words)))
        for place in sorted(random.sample(range(5, 95, 10), random.randint(1, 3))):
            words[place] = "changed"
        rows.append((2 * group + 1, " ".join(words)))
    expected = {rows[n][0] for n in classes(rows, 80)}
    assert expected != {rows[n][0] for n in classes(rows, 85)}
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA)
    kept = corpus_pipeline.near_deduplication(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)
