"""Alignment of two tokenizers' token sequences by pointer jumping.

Tokenizer A is a byte-level BPE over a space and the text, B a sentence-piece BPE over the text (it adds the space itself).
Both cover the same bytes.  Every token points to the farthest-right token that it overlaps; of an A and a B token
that end together, the A token is the terminal.  Doubling the pointers until none moves labels every token with the
terminal of its component, and components are the groups between the places where both sequences end a token.

Neither vocabulary has a token that goes on past a blank after a character that is none, so a text's tokens are those of
its stretches (blanks, then a word) and no group crosses a stretch.  A worker aligns each distinct stretch once and
remembers it, within a bound on characters.

A link joins an A and a B token that end at the same byte; one of the two is then a suffix of the other, so the id pairs
that can ever be linked follow from the vocabularies alone (``Vocabularies.pairs``, under a million).  Corpus-wide counts
of pairs are summed in Spark, and the vector of that fixed length is what tasks receive.

Null and empty texts, and those in which B's bytes differ from a space and the text, have no tokens: zeros and an empty
hash.  Special tokens' strings are plain text.  Rows with a null doc_id and repeated rows are counted and returned as
often as they occur.  Extra columns are ignored; an empty table gives no rows.  A very long stretch
is aligned whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayloom.llm import _bytes as tb
from delayloom.llm._spark import arrow_batches, stored

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
#: Characters that a worker remembers, groups' texts included, and bytes of texts in one step.
REMEMBERED_CHARS, STEP_BYTES = 24_000_000, 1 << 20

#: Behind a token's id: another of its group follows, the group's B tokens follow, or the group ends.
SEPARATORS = ",|;"

ALIGNED_SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
                  "pairs array<int>, times array<int>")

_BEFORE_BLANK = re.compile(r"(?<=\S)(?= )")
_BLANK_AFTER_BLANK = re.compile(r"\s ")


def byte_level_alphabet() -> dict[str, int]:
    """Character of a byte-level vocabulary to byte: printable Latin-1 stands for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(other)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens and the id pairs that can end together."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        with open(path_a, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        alphabet = byte_level_alphabet()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(c in alphabet for c in token):
                self.bytes_a[number] = bytes(alphabet[c] for c in token)
        self.bytes_b = [self._piece(n) for n in range(self.b.vocab_size())]
        self.blank = self.b.piece_to_id("▁")
        # each id with each separator behind it, and the bytes of each token, to be gathered by number
        ids = range(max(len(self.bytes_a), len(self.bytes_b)))
        self.spelt = pa.array([f"{number}{mark}" for number in ids for mark in SEPARATORS])
        self.spelt_sizes = np.array([len(f"{number},") for number in ids for _ in SEPARATORS])
        self.pieces_b = pa.array(self.bytes_b, pa.binary())
        self.sizes_a = np.array([len(x) for x in self.bytes_a])
        self.sizes_b = np.array([len(x) for x in self.bytes_b])
        self.pairs = self._pairs()

    def _piece(self, number: int) -> bytes:
        if self.b.is_byte(number):
            return bytes([int(self.b.id_to_piece(number)[3:5], 16)])
        if self.b.is_control(number) or self.b.is_unknown(number):
            return b""
        return self.b.id_to_piece(number).replace("▁", " ").encode()

    def _pairs(self) -> np.ndarray:
        """Sorted codes a * len(B) + b of all pairs in which one token's bytes end with the other's."""
        by_bytes: tuple[dict[bytes, list[int]], ...] = ({}, {})
        for own, tokens in zip(by_bytes, (self.bytes_a, self.bytes_b)):
            for number, token in enumerate(tokens):
                if token:
                    own.setdefault(token, []).append(number)
        codes = set()
        for token, numbers in by_bytes[0].items():
            for k in range(len(token)):
                codes.update(a * len(self.bytes_b) + b for b in by_bytes[1].get(token[k:], ()) for a in numbers)
        for token, numbers in by_bytes[1].items():
            for k in range(1, len(token)):
                codes.update(a * len(self.bytes_b) + b for a in by_bytes[0].get(token[k:], ()) for b in numbers)
        return np.array(sorted(codes), dtype=np.int64)


    def encoded_a(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of all stretches, and how many each has.

        Many stretches are one text to the tokenizer, cut again by bytes; one that ends in a blank is a text of its own.
        """
        chunks = chunked(stretches)
        texts = ["".join([" " + s for s in stretches[i:j]]) for i, j in zip(chunks, chunks[1:])]
        ids = flat([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.cumsum([len(s.encode("utf-8", "surrogatepass")) + 1 for s in stretches])
        return ids, np.diff(np.searchsorted(np.cumsum(self.sizes_a[ids]), ends, side="right"), prepend=0)

    def encoded_b(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of B; where bytes differ, stretches are encoded alone."""
        chunks = chunked(stretches)
        texts = [" ".join(stretches[i:j]) for i, j in zip(chunks, chunks[1:])]
        found = [ids or [self.blank] for ids in self.b.encode(texts, num_threads=1)]
        ids, sizes = flat(found), np.array(list(map(len, found)))
        if not self.agree(texts, ids, sizes).all():
            found = [ids or [self.blank] for ids in self.b.encode(stretches, num_threads=1)]
            return flat(found), np.array(list(map(len, found)))
        ends = np.cumsum([len(s.encode("utf-8", "surrogatepass")) + 1 for s in stretches])
        return ids, np.diff(np.searchsorted(np.cumsum(self.sizes_b[ids]), ends, side="right"), prepend=0)

    def agree(self, stretches: list[str], ids_b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether B's tokens of each stretch have the bytes of a space and the stretch."""
        whole = [b" " + s.encode("utf-8", "surrogatepass") for s in stretches]
        gathered = gathered_bytes(self.pieces_b, ids_b)
        if gathered == b"".join(whole):  # the usual case; lengths may still be dealt differently
            ends = np.cumsum(self.sizes_b[ids_b])[np.cumsum(sizes) - 1]
            return ends == np.cumsum(list(map(len, whole)))
        ends = np.concatenate([[0], np.cumsum(self.sizes_b[ids_b])])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return np.array([gathered[i:j] == own for own, i, j in zip(whole, ends, ends[1:])])

    def written(
        self, ids_a: np.ndarray, ids_b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, last: np.ndarray, last_b: np.ndarray,
        cuts: np.ndarray,
    ) -> list[str]:
        """Groups of each stretch as ``a1,a2|b1;a3|b2,b3``; ``cuts`` are the tokens up to the end of each stretch."""
        marks_a, marks_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
        marks_a[last], marks_b[last_b] = 1, 2
        order = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")  # by group, A before B
        numbers = np.concatenate([ids_a, ids_b]) * len(SEPARATORS) + np.concatenate([marks_a, marks_b])
        lengths = self.spelt_sizes[numbers[order]]
        text = gathered_bytes(self.spelt, numbers[order]).decode("ascii")
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], cuts])].tolist()
        return [text[i : max(i, j - 1)] for i, j in zip(ends, ends[1:])]


def chunked(stretches: list[str], most: int = 256) -> list[int]:
    """Cuts between stretches that are encoded together: none ends in a blank but the last of a chunk."""
    cuts = [0]
    for number, stretch in enumerate(stretches, 1):
        if number - cuts[-1] == most or not stretch or stretch[-1].isspace():
            cuts.append(number)
    return cuts if cuts[-1] == len(stretches) else [*cuts, len(stretches)]


def flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=sum(map(len, lists)))


def gathered_bytes(values: pa.Array, numbers: np.ndarray) -> bytes:
    """The values of the given numbers one after the other."""
    found = values.take(pa.array(numbers))
    offsets = np.frombuffer(found.buffers()[1], dtype=np.int32)
    return found.buffers()[2].to_pybytes()[offsets[found.offset] : offsets[found.offset + len(found)]] if len(found) else b""


def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terminal (an index into A) of each A and each B token, by pointer jumping.

    ``ends_*`` are the ends of two token sequences over the same bytes, ascending.
    """
    count = len(ends_a)
    over = np.searchsorted(ends_b, ends_a)  # the B token that holds an A token's last byte
    pointer = np.concatenate([
        np.where(ends_b[over] > ends_a, count + over, np.arange(count)),
        np.searchsorted(ends_a, ends_b),
    ])
    while True:
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            return pointer[:count], pointer[count:]
        pointer = further


class _Stretches:
    """What a worker knows of distinct stretches: numbers of tokens and groups, the groups' text and links' pairs."""

    def __init__(self, path_a: str, path_b: str):
        self.words = Vocabularies(path_a, path_b)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.texts: list[str] = []
        self.chars = 0
        self.counts = np.zeros((0, 4), dtype=np.int64)  # A tokens, B tokens, groups, whether the bytes agree
        self.starts = np.zeros(1, dtype=np.int64)
        self.links = np.zeros(0, dtype=np.int32)

    def tidy(self) -> None:
        """Start anew when too much is remembered."""
        if self.chars > REMEMBERED_CHARS:
            self.forget()

    def learn(self, stretches: list[str]) -> None:
        words = self.words
        counts = np.zeros((len(stretches), 4), dtype=np.int64)
        ids_a, counts[:, 0] = words.encoded_a(stretches)
        ids_b, counts[:, 1] = words.encoded_b(stretches)
        agree = words.agree(stretches, ids_b, counts[:, 1])
        if not agree.all():
            ids_a, ids_b = ids_a[np.repeat(agree, counts[:, 0])], ids_b[np.repeat(agree, counts[:, 1])]
            counts[~agree] = 0
        counts[:, 3] = agree
        ends_a, ends_b = np.cumsum(words.sizes_a[ids_a]), np.cumsum(words.sizes_b[ids_b])
        of_a, of_b = group_ends(ends_a, ends_b)
        last = np.flatnonzero(of_a == np.arange(len(of_a)))  # the terminals, one a group
        last_b = np.searchsorted(ends_b, ends_a[last])
        edges = np.searchsorted(last, np.cumsum(counts[:, 0]))  # groups up to the end of each stretch
        counts[:, 2] = np.diff(edges, prepend=0)
        texts = words.written(ids_a, ids_b, of_a, of_b, last, last_b, np.cumsum(counts[:, 0] + counts[:, 1]))
        codes = ids_a[last] * len(words.bytes_b) + ids_b[last_b]
        self.index.update(zip(stretches, range(len(self.texts), len(self.texts) + len(stretches))))
        self.chars += sum(map(len, stretches)) + sum(map(len, texts))
        self.texts += texts
        self.counts = np.concatenate([self.counts, counts])
        self.starts = np.concatenate([self.starts, edges + len(self.links)])
        self.links = np.concatenate([self.links, np.searchsorted(words.pairs, codes).astype(np.int32)])


def stretches(text: str) -> list[str]:
    """Stretches of a space and the text, each without its first blank."""
    whole = " " + text
    if _BLANK_AFTER_BLANK.search(whole) or text[-1:].isspace():
        return [s[1:] for s in _BEFORE_BLANK.split(whole)]
    return text.split(" ")


#: A worker keeps what it knows from task to task.
_known: dict[tuple[str, str], _Stretches] = {}


def _paths(paths: tuple[str, str] | None) -> tuple[str, str]:
    if paths is None:
        import public_tokenizers

        return public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE)
    return paths


def _align(paths: tuple[str, str] | None):
    def rows(known: _Stretches, texts: list[str | None]) -> Iterator[tuple]:
        cut = [stretches(t) if t else [] for t in texts]
        known.tidy()
        new = {s for own in cut for s in own}.difference(known.index)
        if new:
            known.learn(list(new))
        for own in cut:
            at = np.array([known.index[s] for s in own], dtype=np.int64)
            counts = known.counts[at]
            if not len(at) or not counts[:, 3].all():
                yield 0, 0, 0, "", [], []
                continue
            n_a, n_b, n_groups, _ = counts.sum(axis=0).tolist()
            links = known.links[tb.expand(known.starts[at], counts[:, 2])]
            pairs, times = np.unique(links, return_counts=True)
            digest = hashlib.sha256(";".join([known.texts[k] for k in at.tolist()]).encode()).hexdigest()
            yield n_a, n_b, n_groups, digest, pairs, times.astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _paths(paths)
        known = _known.get(own) or _known.setdefault(own, _Stretches(*own))
        schema = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                            ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])
        for batch in batches:
            _, offsets = tb.text_bytes(batch.column("text"))
            for low, high in tb.steps(offsets, STEP_BYTES):
                found = list(rows(known, batch.column("text").slice(low, high - low).to_pylist()))
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), *map(pa.array, columns[:4], schema.types[1:5]),
                     *(pa.array(list(c), pa.list_(pa.int32())) for c in columns[4:])], schema=schema)

    return run


def aligned(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256, and the numbers of linked id pairs with how often they are linked.

    ``paths`` are the two vocabulary files as executors see them; by default the installed public ones.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_align(paths), ALIGNED_SCHEMA)


def _sums(pairs: int):
    """Counts of a task's pairs in one vector of fixed length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(pairs, dtype=np.int64)
        for batch in batches:
            np.add.at(total, batch.column("pairs").flatten().to_numpy(), batch.column("times").flatten().to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["pair", "n"])

    return run


def pair_counts(rows: DataFrame, words: Vocabularies) -> DataFrame:
    """(pair, a, b, n, best): corpus-wide links of each id pair, and whether no pair with its B id has more."""
    size = len(words.bytes_b)
    totals = rows.select("pairs", "times").mapInArrow(_sums(len(words.pairs)), "pair int, n long")
    totals = totals.groupBy("pair").agg(F.sum("n").alias("n"))
    codes = words.pairs

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = codes[batch.column("pair").to_numpy()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("pair"), pa.array(own // size), pa.array(own % size), batch.column("n")],
                names=["pair", "a", "b", "n"])

    counts = stored(totals.mapInArrow(named, "pair int, a long, b long, n long"), "pair-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _scores(counts: np.ndarray, best: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("pairs").value_lengths().to_numpy()
            at, times = batch.column("pairs").flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            of = np.repeat(np.arange(len(sizes)), sizes)
            added = []
            for worth in (1, best[at], counts[at]):
                total = np.zeros(len(sizes), dtype=np.int64)
                np.add.at(total, of, times * worth)
                added.append(pa.array(total))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")), *added, batch.column("groups_sha256")],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return run


def alignment(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """Per document: tokens, groups, links, links whose pair is its B id's commonest, and the sum of links' counts."""
    words = Vocabularies(*_paths(paths))
    with arrow_batches(docs.sparkSession):
        rows = stored(aligned(docs, paths), "aligned")
    found = pair_counts(rows, words).select("pair", "n", "best").toArrow()  # at most len(words.pairs) rows
    at = found.column("pair").to_numpy()
    counts, best = np.zeros(len(words.pairs), dtype=np.int64), np.zeros(len(words.pairs), dtype=np.int64)
    counts[at], best[at] = found.column("n").to_numpy(), found.column("best").to_numpy()
    return rows.mapInArrow(
        _scores(counts, best),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
