"""Token alignment against whole encodings of each text, walked byte by byte."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from delayloom.llm import token_alignment
from delayloom.llm.queries import importable

SCHEMA = "doc_id long, text string, n_a long, pairs string, n_links string"
FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module", autouse=True)
def _ready(spark):
    importable(spark)


@pytest.fixture(scope="module")
def words():
    return token_alignment.Vocabularies(*token_alignment._paths(None))


def groups_of(words, text):
    """[(ids of A, ids of B)] between common ends, or None."""
    if not text:
        return None
    whole = (" " + text).encode()
    found = (words.a.encode(" " + text, add_special_tokens=False).ids, words.b.encode(text))
    cuts = []
    for ids, of in zip(found, (words.bytes_a, words.bytes_b)):
        if b"".join(of[i] for i in ids) != whole:
            return None
        cuts.append(np.cumsum([len(of[i]) for i in ids]).tolist())
    out, at = [], [0, 0]
    for end in sorted(set(cuts[0]) & set(cuts[1])):
        to = [c.index(end, k) + 1 for c, k in zip(cuts, at)]
        out.append(tuple(ids[k:t] for ids, k, t in zip(found, at, to)))
        at = to
    return out


def plain(words, texts):
    all_groups = [groups_of(words, t) or [] for t in texts]
    counts = Counter((a[-1], b[-1]) for own in all_groups for a, b in own)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = []
    for own in all_groups:
        pairs = [(a[-1], b[-1]) for a, b in own]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in own)
        rows.append((sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), len(pairs),
                     sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs),
                     hashlib.sha256(text.encode()).hexdigest() if own else ""))
    return rows


TEXTS = ["Réaile éen ètreê ré, ançeau des queai.", "a  b\n c", " x ", "x ", "  ", "\n", "a\xa0 b", "a\x1c b", "a\x85 b", "a　 b",
         "日本 語 é ́", "<|endoftext|> <s> a", "a▁b", " ", "\t a", "it's we'll  DON'T\r\n", "​ a", "0" * 30, "a\0b", "", None,
         "same words here", "same words here"]


def test_documents_match(spark, words):
    texts = TEXTS + ["z" * 30000, "q w " * 20000]
    docs = spark.createDataFrame([(None if i == 3 else i, t, -1, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    found = {r["doc_id"]: tuple(r[f] for f in FIELDS) for r in token_alignment.alignment(docs).collect()}
    wanted = plain(words, texts)
    assert found == {None if i == 3 else i: row for i, row in enumerate(wanted)}


def test_given_documents_match(spark, words):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: tuple(r[f] for f in FIELDS) for r in token_alignment.alignment(docs).collect()}
    assert found == dict(enumerate(plain(words, texts)))


def test_empty_table(spark):
    assert token_alignment.alignment(spark.createDataFrame([], SCHEMA)).count() == 0


def test_forgetting_changes_nothing(spark, words, monkeypatch):
    monkeypatch.setattr(token_alignment, "REMEMBERED_CHARS", 1)
    known = token_alignment._Stretches(*token_alignment._paths(None))
    for text in filter(None, TEXTS):
        known.tidy()
        own = token_alignment.stretches(text)
        known.learn([s for s in set(own) if s not in known.index])
        at = [known.index[s] for s in own]
        groups = groups_of(words, text)
        assert bool(known.counts[at][:, 3].all()) == (groups is not None)
        if groups:
            assert ";".join(known.texts[k] for k in at) == ";".join(
                f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=40), st.lists(st.integers(1, 5), min_size=1, max_size=40))
def test_pointer_jumping_labels_components(sizes_a, sizes_b):
    short = sum(sizes_a) - sum(sizes_b)
    (sizes_b if short > 0 else sizes_a).extend([1] * abs(short))
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    of_a, of_b = token_alignment.group_ends(ends_a, ends_b)
    both = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    assert ends_a[of_a].tolist() == [min(e for e in both if e >= end) for end in ends_a.tolist()]
    assert ends_a[of_b].tolist() == [min(e for e in both if e >= end) for end in ends_b.tolist()]


def test_byte_level_alphabet(words):
    assert b"".join(words.bytes_a[i] for i in words.a.encode("é\n\x00­ x", add_special_tokens=False).ids) == "é\n\x00­ x".encode()
    assert set(token_alignment.byte_level_alphabet().values()) == set(range(256))
    assert len(words.pairs) < 1_000_000
