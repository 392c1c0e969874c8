"""Fuzzy hashing of fingerprints against all pairs, and the fingerprints against a plain count of bits."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from delayloom.llm import fuzzy_simhash
from delayloom.llm.queries import importable

SCHEMA = "doc_id long, text string, bits long, fingerprint string, component_id string"


@pytest.fixture(scope="module", autouse=True)
def _ready(spark):
    importable(spark)


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ")
    for blank in "\t\n\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_classes(rows):
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations(enumerate(rows), 2):
        if (a[1] ^ b[1]).bit_count() <= 4:
            parent[root(i)] = root(j)
    least = {}
    for n, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(n)] = min(doc_id, least.get(root(n), doc_id))
    return sorted(((doc_id, f"{bits:016x}", least.get(root(n))) for n, (doc_id, bits) in enumerate(rows)), key=str)


def classes(spark, rows):
    docs = spark.createDataFrame([(i, t, 3, "x", "y") for i, t in rows], SCHEMA)
    return sorted(map(tuple, fuzzy_simhash.near_duplicates(docs).collect()), key=str)


def near_texts(count, seed):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(9999)}" for _ in range(300)]
    rows = []
    for i in range(count):
        words = list(base)
        for _ in range(draw.randrange(0, 12)):
            words[draw.randrange(300)] = f"z{draw.randrange(10**6)}"
        rows.append((i, " ".join(words) if i % 3 else " ".join(f"u{draw.randrange(999)}" for _ in range(40))))
    return rows


def test_texts_match_all_pairs(spark):
    rows = near_texts(300, 1) + [(None, "One two\tthree"), (None, "one TWO three"), (900, "one two three"), (901, None), (902, ""),
                                 (903, " \n\x0b"), (904, "É é"), (905, "a " * 30000), (905, "a " * 30000), (906, "w " * 3)]
    assert classes(spark, rows) == plain_classes([(i, plain_fingerprint(t)) for i, t in rows])


def test_given_documents_match_all_pairs(spark):
    found = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in found]
    assert classes(spark, rows) == plain_classes([(i, plain_fingerprint(t)) for i, t in rows])


def linked(spark, bits):
    values = np.array(bits, dtype=np.uint64).view(np.int64).tolist()
    found = fuzzy_simhash.links(spark.createDataFrame([(v,) for v in values], "bits long")).collect()
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in found)
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        parent[root(a)] = root(b)
    wanted = {}
    for (n, v), (m, w) in combinations(enumerate(values), 2):
        if (bits[n] ^ bits[m]).bit_count() <= 4:
            wanted.setdefault(v, []).append(w)
    assert all(root(v) == root(w) for v, others in wanted.items() for w in others)
    return len(found)


def test_crowded_keys_are_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(fuzzy_simhash, "BLOCK", 20)
    draw = random.Random(3)
    bits = {draw.getrandbits(64) ^ sum(1 << draw.randrange(64) for _ in range(2)) for _ in range(20)}
    centre = draw.getrandbits(64)
    bits |= {centre ^ (1 << a) ^ (1 << b) ^ (1 << c) for a, b, c in (draw.sample(range(64), 3) for _ in range(250))}
    linked(spark, sorted(bits))


def test_many_links_are_joined_on_the_way(spark, monkeypatch):
    monkeypatch.setattr(fuzzy_simhash, "HELD_LINKS", 50)
    bits = sorted({sum(1 << b for b in pair) for pair in combinations(range(0, 64, 3), 2)})
    own = np.array(bits, dtype=np.uint64).view(np.int64)
    a, b = fuzzy_simhash.linked_in_key(own, None, 4)
    assert len(a) == len(bits) - 1  # all differ in four bits at most, so one class
    assert linked(spark, bits) >= len(bits) - 1


def test_every_pattern_of_four_errors_shares_a_key():
    centre = 0x9E3779B97F4A7C15
    own = fuzzy_simhash.keys(np.array([centre], dtype=np.uint64))[0]
    patterns = np.array([sum(1 << b for b in bits) for bits in combinations(range(64), 4)], dtype=np.uint64)
    for low in range(0, len(patterns), 100_000):
        near = fuzzy_simhash.keys(patterns[low : low + 100_000] ^ np.uint64(centre))
        assert np.isin(near, own).any(axis=1).all()


def test_golay_indices():
    words = np.arange(1 << 23, dtype=np.int64)[:: 1 << 9]
    found = fuzzy_simhash.indices(words)
    assert {len(set(row)) for row in found.tolist()} == {1, 6}
    for flips in ((1,), (1 << 22,), (1 << 3, 1 << 17)):
        near = fuzzy_simhash.indices(words ^ sum(flips))
        assert all(set(a) & set(b) for a, b in zip(found.tolist(), near.tolist()))


def test_empty_table(spark):
    assert classes(spark, []) == []
