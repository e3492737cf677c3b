"""Byte-pair encoding by backtracking, and decoding by an offset table.

Encoding one pre-token (a piece the vocabulary's pattern cuts) walks from left to right: an
Aho-Corasick automaton over the vocabulary gives the longest token at every byte; a token may
follow the last one only if merging could have left the two side by side, which a table of
pairs answers (a pair of tokens is compatible if no merge of lower rank joins across their
border while they are taken apart).  If no shorter token fits either, the step before is
undone and its end is marked as dead, so that no byte is tried twice with the same outcome.
The tokens found are exactly those of the merge rules, in time linear in the text.

Decoding gathers the tokens' bytes from one array by their offsets.

Defined cases
    null or empty text  no tokens; decodes to the empty text
    text of the special token
                        that token's id, as the library does
    repeated rows       one output row per input row
    null doc_id         passed through
    empty table         no rows
    further columns     not read
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens.llm.common import batch_of

# Fixed value: the pattern by which the byte-level vocabularies cut a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Unicode white space.  Runs without it, with the space before, are cut further by PATTERN;
# both ways of cutting agree on every border at white space.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUNS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
CACHE_WORDS = 800_000   # pre-tokens a worker remembers
CACHE_CHARS = 48        # longer ones are encoded anew


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte, to that byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tables of one byte-level vocabulary file (its JSON text), whose ids above the single
    bytes follow the order of the merges."""

    def __init__(self, text: str):
        spec = json.loads(text)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*ids.values(), *self.special.values()])
        self.token: list[bytes] = [b""] * size
        for t, k in ids.items():
            self.token[k] = bytes(letters[c] for c in t)
        self.merge: dict[tuple[int, int], int] = {}
        self.halves: list[tuple[int, int]] = [(k, k) for k in range(size)]
        self.rank = [-1] * size
        for n, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merge[ids[a], ids[b]] = n
            self.rank[ids[a + b]], self.halves[ids[a + b]] = n, (ids[a], ids[b])
        self.length = [len(t) for t in self.token]
        by_bytes = {t: k for k, t in enumerate(self.token) if t}
        self.automaton = ahocorasick.Automaton()
        for t, k in by_bytes.items():
            self.automaton.add_word(t.decode("latin-1"), (len(t), k))
        self.automaton.make_automaton()
        self.shorter = [-1] * size      # the longest proper prefix that is a token
        for t, k in by_bytes.items():
            for n in range(len(t) - 1, 0, -1):
                if t[:n] in by_bytes:
                    self.shorter[k] = by_bytes[t[:n]]
                    break
        for t, k in self.special.items():
            self.token[k] = t.encode("utf-8")
        self.blob = np.frombuffer(b"".join(self.token), dtype=np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(t) for t in self.token])]).astype(np.int64)
        self.known: dict[tuple[int, int], bool] = {}
        self.words: dict[str, str] = {}
        self.cut = regex.compile(PATTERN).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def beside(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` as neighbours."""
        got = self.known.get((left, right))
        if got is None:
            if len(self.known) > 1_000_000:
                self.known.clear()
            got = self.known[left, right] = self._beside(left, right)
        return got

    def _beside(self, left: int, right: int) -> bool:
        """Takes the later-made of the two pieces at the border apart, again and again.  The
        pieces at hand stood side by side until the merge just undone, so a merge of the two
        must not come before it (nor tie with it on the right: merging goes left to right)."""
        merge, rank, halves = self.merge, self.rank, self.halves
        until = len(merge)
        while True:
            if merge.get((left, right), until) < until:
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            if rank[left] > rank[right]:
                until, left = rank[left], halves[left][1]
            else:
                until, right = rank[right] + 1, halves[right][0]

    def piece(self, data: bytes) -> list[int]:
        """Tokens of one pre-token."""
        n = len(data)
        longest = [0] * n
        for end, (size, k) in self.automaton.iter(data.decode("latin-1")):
            longest[end - size + 1] = k        # ends ascend: the longest comes last
        length, shorter, beside = self.length, self.shorter, self.beside
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0]
        while True:
            end = at + length[token]
            if not dead[end] and (not out or beside(out[-1], token)):
                out.append(token)
                if end == n:
                    return out
                at, token = end, longest[end]
                continue
            token = shorter[token]
            while token < 0:                   # nothing fits here: undo the last step
                dead[at] = 1
                token = out.pop()
                at -= length[token]
                token = shorter[token]

    def run(self, text: str) -> str:
        """Tokens, as joined decimals, of a run without inner white space."""
        words, found = self.words, []
        for word in self.cut(text):
            got = words.get(word)
            if got is None:
                got = ",".join(map(str, self.piece(word.encode("utf-8"))))
                self.remember(word, got)
            found.append(got)
        got = ",".join(found)
        self.remember(text, got)
        return got

    def remember(self, word: str, got: str) -> None:
        if len(word) <= CACHE_CHARS:
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[word] = got

    def encode(self, text: str | None) -> str:
        """Token ids of ``text`` as decimals joined by commas."""
        if not text:
            return ""
        shown: list[str] = []
        words, run = self.words, self.run
        special = self.specials is not None and any(s in text for s in self.special)
        for part in self.specials.split(text) if special else [text]:
            if special and part in self.special:
                shown.append(str(self.special[part]))
            else:
                shown += [words.get(r) or run(r) for r in RUNS.findall(part)]
        return ",".join(shown)

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        start = self.offset[ids]
        size = self.offset[ids + 1] - start
        end = np.cumsum(size)
        where = np.repeat(start - (end - size), size) + np.arange(end[-1])
        return self.blob[where].tobytes().decode("utf-8", "replace")


_LOADED: dict[str, Vocabulary] = {}    # a worker's tables, by the file's digest


def loaded(key: str, text: Broadcast) -> Vocabulary:
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(text.value)
    return _LOADED[key]


def parsed(decimals: str) -> np.ndarray:
    return np.fromstring(decimals, dtype=np.int64, sep=",") if decimals else np.zeros(0, np.int64)


def _vocabulary(df: DataFrame, path: str) -> tuple[str, Broadcast]:
    """Digest and broadcast text of the vocabulary file (its size is fixed: a few MB)."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return hashlib.sha256(text.encode()).hexdigest(), df.sparkSession.sparkContext.broadcast(text)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) of every row, with the vocabulary file at ``path``."""
    key, text = _vocabulary(docs, path)
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(key, text)
        for b in batches:
            ids = [parsed(vocabulary.encode(t)).astype(np.int32) for t in b.column(1).to_pylist()]
            yield batch_of(out, [b.column(0), ids])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, ids array<int>"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``text`` of rows with ``doc_id``, ``ids``; null ids decode to the empty text."""
    key, text = _vocabulary(encoded, path)
    out = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(key, text)
        for b in batches:
            yield batch_of(out, [b.column(0), [
                vocabulary.decode(np.array(k or [], dtype=np.int64)) for k in b.column(1).to_pylist()]])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``ids``: encodes
    every row and decodes the ids again.  Without ``ids`` only digests leave the task."""
    key, text = _vocabulary(docs, path)
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    out = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(key, text)
        sha = hashlib.sha256
        for b in batches:
            counts, shown, back, found = [], [], [], []
            for t in b.column(1).to_pylist():
                decimals = vocabulary.encode(t)
                ids = parsed(decimals)
                counts.append(len(ids))
                shown.append(sha(decimals.encode()).hexdigest())
                back.append(sha(vocabulary.decode(ids).encode("utf-8")).hexdigest())
                if with_ids:
                    found.append(ids.astype(np.int32))
            yield batch_of(out, [b.column(0), counts, shown, back] + [found] * with_ids)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids))
