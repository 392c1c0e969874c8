"""Each operator against brute force, and on nulls, empty tables, ties, repeated rows and clashing columns."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from delayloom.llm import (
    chosen_path,
    decontaminate,
    langid,
    line_dedup,
    packing,
    pii,
    quality,
    suffix_dedup,
    toxicity,
    url_filter,
)
from delayloom.llm.queries import importable

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string, score double"


@pytest.fixture(scope="module", autouse=True)
def _ready(spark):
    importable(spark)


def documents(spark, rows):
    """Rows of (doc_id, text) with columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "en", "s", 1, -1, "x", 2.0) for i, t in rows], SCHEMA)


def edge_rows():
    same = "one two three four five six seven"
    return [(None, same), (1, None), (2, ""), (3, " \n\t "), (4, same), (4, same), (5, same), (6, "z" * 3000), (7, "a b " * 800)]


def near_copies(count, seed=4):
    """Copies of one text with up to three words changed, so that most but not all are linked."""
    random.seed(seed)
    base = [f"w{random.randrange(9999)}" for _ in range(120)]
    rows = []
    for i in range(count):
        words = list(base)
        for _ in range(random.randrange(0, 5)):
            words[random.randrange(120)] = f"z{random.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows


def linked_classes(rows):
    def shingles(text):
        words = (text or "").lower().split()
        if len(words) < 5:
            return frozenset([tuple(words)] if words else [])
        return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a | b and 100 * len(a & b) >= 85 * len(a | b):
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i, _ in sets}, {i: len(s) for i, s in sets}


def test_near_duplicates_in_blocks_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BLOCK", 40)
    monkeypatch.setattr(chosen_path, "SMALL_NODE", 10)
    rows = near_copies(160) + [(900 + n, t) for n, (_, t) in enumerate(edge_rows())]
    classes, sizes = linked_classes(rows)
    got = chosen_path.near_duplicates(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == classes
    assert {r.doc_id: r.n_shingles for r in got} == sizes


def boilerplate(count, copies, seed=11):
    """Texts that share half of their words but are not linked, then near copies of the first ones."""
    random.seed(seed)
    shared = [f"w{random.randrange(9999)}" for _ in range(100)]
    texts = [shared + [f"u{n}x{k}" for k in range(40)] for n in range(count)]
    texts += [[*t[:-1], "changed"] for t in texts[:copies]]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_near_duplicates_in_crowds(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BLOCK", 20)
    monkeypatch.setattr(chosen_path, "SMALL_NODE", 10)
    placed, linked = [], chosen_path.stored

    def watched(df, name, *more):
        out = linked(df, name, *more)
        if name == "nodes":
            placed.append(out)
        return out

    monkeypatch.setattr(chosen_path, "stored", watched)
    rows = boilerplate(300, 40)
    got = {r.doc_id: r.component_id for r in chosen_path.near_duplicates(documents(spark, rows)).collect()}
    assert got == linked_classes(rows)[0]
    assert len(placed) > 2  # the crowd went to further depths
    for nodes in placed:
        assert nodes.groupBy("node").count().agg(F.max("count")).first()[0] <= 3 * 20  # two blocks, dealt by a hash


def test_pairs_of_blocks_meet_once(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BLOCK", 8)
    rows = [(d, 0 if d < 30 else d) for d in range(70)]
    frame = spark.createDataFrame(rows, "doc long, class long").withColumns({"tree": F.lit(0), "largest": F.lit(0).cast("long")})
    tasks = {}
    for r in frame.withColumn("at", F.explode(chosen_path._tasks(F.lit(70), F.lit(40)))).select("doc", "class", "at.*").collect():
        tasks.setdefault(r.part, []).append(r)
    met = [
        tuple(sorted((a.doc, b.doc))) for own in tasks.values() for k, a in enumerate(own) for b in own[:k]
        if a.side == chosen_path.ALL_PAIRS or a.side != b.side
    ]
    assert sorted(met) == sorted((a, b) for a, p in rows for b, q in rows if a < b and p != q)


def test_near_duplicates_edges(spark):
    got = chosen_path.near_duplicates(documents(spark, edge_rows())).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} >= {(4, 4, True), (5, 4, False), (None, 4, False), (1, 1, True)}
    assert chosen_path.near_duplicates(documents(spark, [])).count() == 0


def repeats_by_brute_force(rows, size=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - size + 1):
            first[b[k : k + size]] = min(first.get(b[k : k + size], i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if first[b[k : k + size]] < i:
                gone[k : k + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_dedup_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_TEXT_BYTES", 6000.0)
    random.seed(1)
    base = ["".join(random.choice("ab é") for _ in range(120)) for _ in range(8)]
    rows = []
    for _ in range(150):
        text = ""
        for _ in range(random.randint(0, 4)):
            kind, a = random.random(), random.randint(0, 60)
            text += (random.choice(base)[a : a + random.randint(20, 110)] if kind < 0.5 else
                     random.choice(["a" * 120, "ab" * 70, "De " * 40]) if kind < 0.7 else
                     "".join(random.choice("abcdefgh ") for _ in range(random.randint(1, 90))))
        rows.append((random.randint(0, 140), text if random.random() > 0.05 else None))
    assert sorted(map(tuple, suffix_dedup.remove_repeats(documents(spark, rows)).collect())) == repeats_by_brute_force(rows)


def test_suffix_dedup_edges(spark):
    got = suffix_dedup.remove_repeats(documents(spark, edge_rows()), with_kept=True).collect()
    assert len(got) == len(edge_rows())
    assert all(r.n_bytes - r.n_removed == len(r.kept) for r in got)
    assert suffix_dedup.remove_repeats(documents(spark, [])).count() == 0


def test_packing_round_trip(spark):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = edge_rows() + [(20, "Ça\u00a0 va\u2003\n\n  bien <|endoftext|> now  "), (21, "word " * 5000)]
    got = packing.pack_documents(documents(spark, rows)).collect()
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    for doc_id, text in rows:
        ids = np.array(own.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = [r for r in got if r.doc_id == doc_id]
        assert sum(p.length for p in pieces) == len(ids) * sum(1 for i, _ in rows if i == doc_id)
        assert all(zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for p in pieces)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert packing.pack_documents(documents(spark, [])).count() == 0


def test_packing_exchanges_and_bounds(spark):
    import numpy as np

    random.seed(5)
    lengths = [random.randint(1, 2048) for _ in range(4000)]
    frame = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], packing.PIECE_SCHEMA)
    got = packing.pack(frame, group_pieces=500).collect()
    assert sorted(r.length for r in got) == sorted(lengths)
    used, bound = len({r.sequence_id for r in got}), packing.lower_bound(np.array(lengths))
    assert bound <= used <= bound * 1.03


def test_lines_match_brute_force(spark):
    random.seed(2)
    pool = [f"line {n}" for n in range(12)] + ["", "  ", "word " * 60, "half " * 30, "rest " * 22]
    rows = [(i, "\n".join(random.choice(pool) for _ in range(random.randint(0, 9)))) for i in range(120)] + [(None, "x\ny\nz"), (200, None)]
    got = {r.doc_id: r for r in line_dedup.delete_repeated_runs(documents(spark, rows)).collect()}
    seen, lost = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = [(k, x.strip()) for k, x in enumerate((text or "").split("\n")) if x.strip()]
        gone = set()
        for n in range(len(lines)):
            for size in (3, 2, 1):
                run = tuple(x for _, x in lines[n : n + size])
                if len(run) == size and (size == 3 or sum(len(x.split()) for x in run) >= 50):
                    if run in seen:
                        gone.update(k for k, _ in lines[n : n + size])
                    seen.add(run)
        lost[i] = gone
    for i, text in rows:
        expected = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in lost[i])
        assert got[i].text == expected
        assert got[i].n_removed == len(lost[i])
    assert line_dedup.delete_repeated_runs(documents(spark, [])).count() == 0


def test_two_lines_of_over_fifty_words_are_a_run(spark):
    a, b = (" ".join(f"{name}{k}" for k in range(40)) for name in "ab")
    rows = [(1, f"{a}\n{b}\nx\n{a}\n{b}"), (2, f"y\n{a}\n \n{b}"), (3, a), (4, f"{b}\n{a}")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed, r.n_runs) for r in line_dedup.delete_repeated_runs(documents(spark, rows)).collect()}
    assert got == {1: (f"{a}\n{b}\nx", 5, 2, 1), 2: ("y\n ", 3, 2, 1), 3: (a, 1, 0, 0), 4: (f"{b}\n{a}", 2, 0, 0)}


def test_winnowing_selects_fewer_places_than_windows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    places = line_dedup._places(line_dedup._sequences(docs), 3, 50)
    size = places.agg(F.count("*").alias("places"), F.sum(F.size("windows")).alias("windows"),
                      F.countDistinct("doc_id", "mark", "place").alias("distinct")).first()
    assert size.places == size.distinct < 0.8 * size.windows


def test_benchmark_items_are_found_with_edits(spark):
    random.seed(3)
    words = ["".join(random.choice("abcdefghij") for _ in range(random.randint(2, 7))) for _ in range(400)]
    items = [(k, " ".join(random.choice(words) for _ in range(random.randint(20, 70)))) for k in range(20)]
    rows, expected = edge_rows(), set()
    for i in range(80):
        item, text = random.choice(items)
        letters = list(text)
        for _ in range(random.randint(0, len(letters) * 3 // 100)):
            place = random.randrange(len(letters))
            letters[place] = random.choice(["x", "", "yz"])
        around = " ".join(random.choice(words) for _ in range(random.randint(0, 40)))
        rows.append((100 + i, f"{around} {''.join(letters).upper()}\n {around}"))
        expected.add((100 + i, item))
    rows += [(300 + i, " ".join(random.choice(words) for _ in range(200))) for i in range(30)]
    benchmark = spark.createDataFrame([(k, t, 1) for k, t in items] + [(90, None, 1), (91, "", 1)], "item_id long, text string, doc_id long")
    found = decontaminate.contaminated(documents(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    assert decontaminate.contaminated(documents(spark, rows), benchmark.limit(0)).count() == 0
    kept = decontaminate.drop_contaminated(documents(spark, rows), benchmark)
    assert kept.count() == len(rows) - len({i for i, _ in expected})


def test_quality_measures_and_verdicts(spark):
    good = [(1000 + i, " ".join(random.choice("the of and text some words here more lines".split()) + str(k) for k in range(80)) + ".") for i in range(60)]
    bad = [(2000 + i, " ".join(f"w{k}*** #$%" for k in range(40))) for i in range(6)]
    rows = good + bad + [(200, "a b c d e f g h\na b c d e f g h\nx")] + edge_rows()[:4]
    got = {r.doc_id: r for r in quality.judged(documents(spark, rows)).collect()}
    assert all(got[i].kept for i, _ in good) and not any(got[i].kept for i, _ in bad)
    assert (got[200].n_words, got[200].n_dup_lines, got[200].n_repeat_words, got[200].base_failed) == (17, 1, 16, True)
    assert got[1].n_words == 0 and got[1].base_failed
    assert quality.judged(documents(spark, [])).count() == 0


def test_personal_data_matches_patterns(spark):
    texts = ["mail a.b@c.de%x@y.org. é +1 (377) 555-0271, 10.20.30.40 and 1.2.3.400", "4111 1111 1111 1111 2390409500648960",
             "a@@b@c.d 1.2.3.4.5.6.7.8 +12 3", "9" * 5000, "x" * 5000 + "@", None, ""]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, texts[0])]
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def passes(kind, match):
        digits = re.sub("[^0-9]", "", match)
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return {"email": True, "ip": all(int(p) <= 255 for p in match.split(".")) if kind == "ip" else None,
                "card": 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15}[kind]

    for r in pii.found(documents(spark, rows)).collect():
        text = (texts[0] if r.doc_id is None else texts[r.doc_id]) or ""
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p in patterns.items() for m in re.finditer(p, text) if passes(k, m.group())]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r.spans.split(",")) or not spans
    assert pii.found(documents(spark, [])).count() == 0


def test_urls(spark):
    urls = [f"http://a{i}.example.{top}/{lang}/{i}?x=1" for i in range(40) for top in ("org", "com", "net") for lang in ("en", "fr", "de", "es")]
    urls += [None, "", "no scheme", "HTTP://WWW.Example.ORG", "x://example.org/en/12#y", "x://notorg/"]
    pages = spark.createDataFrame([(i, u, "a", "b") for i, u in enumerate(urls)], "page_id long, url string, host string, score string")
    got = {r.page_id: r for r in url_filter.judged(pages).collect()}
    n = len(urls)
    assert len(got) == n and {r.verdict for r in got.values()} <= {"allow", "block"}
    assert (got[n - 6].host, got[n - 6].path, got[n - 6].rule) == ("", "", None)
    assert (got[n - 3].host, got[n - 3].path, got[n - 3].rule) == ("www.example.org", "", None)
    assert (got[n - 2].rule, got[n - 2].verdict) == ("example.org/en/1", "block") and got[n - 1].rule is None
    assert url_filter.judged(pages.limit(0)).count() == 0


def test_languages(spark):
    random.seed(6)
    stock = {"xx": "tho the wer and ing ent".split(), "yy": "ción que los ñar est ado".split()}
    rows = [(i, " ".join(random.choice(stock[lang]) for _ in range(40)), lang) for i in range(400) for lang in (("xx", "yy")[i % 2],)]
    rows += [(1000, None, "xx"), (1001, "12 34", "yy"), (1002, "the and tho", None), (None, "que los ñar", "yy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identified(docs.withColumn("score", F.lit("x"))).collect()}
    held = [(i, lang) for i, _, lang in rows if i is not None and i < 1000 and got[i].held_out]
    assert held and sum(got[i].lang_pred == lang for i, lang in held) / len(held) > 0.98
    assert (got[1000].lang_pred, got[1001].lang_pred, got[1002].lang_pred, got[None].lang_pred) == ("und", "und", "xx", "yy")
    assert langid.identified(docs.limit(0)).count() == 0


def test_toxicity(spark):
    random.seed(7)
    plain = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(900):
        words = [random.choice(plain) for _ in range(40)]
        if i % 8 == 0:
            words[random.randrange(40)] = "vilest" + random.choice("abcdef")
        rows.append((i, " ".join(words)))
    docs = documents(spark, rows + edge_rows()[1:3])
    labels = spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i, _ in rows] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == len(rows) + 2 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id >= 8]
    assert all(r.predicted == int(r.doc_id % 8 == 0) for r in held)
    assert toxicity.scored(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.scored(docs, labels.limit(0)).collect()} == {0.0}


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, kept = docs.columns, docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, "/root/testdata/sf0.001")
        assert kept.columns == columns
    rest = {r.doc_id for r in kept.select("doc_id").collect()}
    assert 0 < len(rest) < docs.count()
    assert {r.doc_id for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").select("doc_id").collect()} == rest
