"""Benchmark decontamination: rare-word seeds, a bound on the score, then Smith-Waterman alignment of words.

The words of a block of test items get numbers; a document is read as the numbers of its
words (-1 for a word of no item).  How often each word of the items occurs in the whole corpus is
counted.  An alignment that is similar enough matches a least number of an item's words, so it
matches ``need`` of the rarest ones even if it matches all the others; those are the item's seeds.
``m`` matches within ``L`` words score at most ``2 m - (L - m)``: a document meets an item where its
seeds, and then all its words that the item has, lie close enough for the score that is asked for.
The bounds follow from the scores alone, so no alignment that is similar enough is left out, however
its copy was edited; counts only choose which words are seeds.  Local alignment (which forgives replaced, inserted and dropped words) then
scores the pair; its score over that of the whole item is the similarity.

Items are taken in blocks of about ``BLOCK_ITEMS`` items and ``BLOCK_CHARS`` characters at most
(by a hash; a single longer item is a block of its own size), each against all documents; what
travels to the tasks is the words of one block.

Defined cases
    null or empty text  no words: neither a document nor an item of that kind matches
    items of fewer than ``SHORT`` words
                        match as a whole only
    repeated documents  a pair (doc_id, item_id) is reported once, with its best alignment
    repeated or null item_id
                        equal ids are one item id in the result, null included
    null doc_id         reported under null; ``clean`` judges each row by its own text
    empty tables        no rows; nothing is removed
    further columns     not read by ``contamination``; kept untouched by ``clean``
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lessonlens.llm.common import batch_of, stored

SHORT = 3                # words of an item from which a part of it may match
SEEDS = 0.6              # of the least number of matches, the share asked of the seeds
SIMILARITY = 0.4         # least share of the item's own score
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 4_000_000  # of the items of a block, about
MEMO_TOKENS = 500_000    # a worker remembers
PAIRS = 128              # pairs aligned at a time, fewer if they are long
CELLS = 1 << 21          # of a row of the pairs aligned at a time, about
HITS = 1 << 18           # seeds met looked at together, about (those of one text at least)
PAIR_COUNTS = 1 << 20    # pairs of text and item whose seeds are counted together (those of one text at least)

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def runs(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first[0]``, ``first[0] + 1`` ... (``n[0]`` of them), then those from ``first[1]``, and so on."""
    return np.arange(int(n.sum())) + np.repeat(first - np.cumsum(n) + n, n)


class Numbers:
    """Word numbers of texts, a batch of them at a time.  What stands between white space is looked up at
    once if it is of ASCII letters and digits, cut at other characters first if it is of ASCII, and
    else read by ``words_of``, each different one once."""

    def __init__(self, known: dict[str, int]):
        self.known = known
        self.words = pa.array(list(known), pa.large_string())
        self.number = np.append(np.fromiter(known.values(), np.int32, len(known)), np.int32(-1))
        self.memo: dict[str, tuple[int, ...]] = {}

    def found(self, token: str) -> tuple[int, ...]:
        got = self.memo.get(token)
        if got is None:
            if len(self.memo) > MEMO_TOKENS:
                self.memo.clear()
            got = self.memo[token] = tuple(self.known.get(w, -1) for w in words_of(token))
        return got

    def look_up(self, words: pa.Array) -> np.ndarray:
        """Numbers of lower-case words, -1 for a word of no item."""
        return self.number[pc.index_in(words, value_set=self.words).fill_null(len(self.known)).to_numpy()]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of the texts, one text after another, and where each text starts (and
        the last one ends)."""
        split = pc.utf8_split_whitespace(texts.cast(pa.large_string()))
        tokens = split.flatten()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(split).fill_null(0).to_numpy())]).astype(np.int64)
        plain = pc.ascii_is_alnum(tokens)
        mixed = pc.and_not(pc.string_is_ascii(tokens), plain)
        other = pc.invert(pc.string_is_ascii(tokens))
        plain_at, mixed_at, other_at = (np.flatnonzero(m.to_numpy(zero_copy_only=False)) for m in (plain, mixed, other))
        n = np.ones(len(tokens), dtype=np.int64)
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(
            pc.ascii_lower(tokens.filter(mixed)), pattern="[^0-9a-z]+", replacement=" "))
        parts = cut.flatten()
        there = pc.not_equal(parts, "")
        owner = pc.list_parent_indices(cut).to_numpy()[there.to_numpy(zero_copy_only=False)]
        n[mixed_at] = np.bincount(owner, minlength=len(mixed_at))
        rest = tokens.filter(other).dictionary_encode()
        each = [self.found(t) for t in rest.dictionary.to_pylist()]
        length = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
        code = rest.indices.to_numpy()
        n[other_at] = length[code]
        start = np.concatenate([[0], np.cumsum(n)])
        numbers = np.empty(start[-1], dtype=np.int32)
        numbers[start[plain_at]] = self.look_up(pc.ascii_lower(tokens.filter(plain)))
        numbers[runs(start[mixed_at], n[mixed_at])] = self.look_up(parts.filter(there))
        values = np.fromiter((k for x in each for k in x), dtype=np.int32, count=int(length.sum()))
        numbers[runs(start[other_at], n[other_at])] = values[runs((np.cumsum(length) - length)[code], length[code])]
        return numbers, start[ends]


@dataclass
class Block:
    """Test items as word numbers."""
    items: list[tuple[int | None, np.ndarray]]
    numbers: dict[str, int]
    memo: Numbers | None = None                                # a worker's

    @staticmethod
    def of(rows: list[tuple[int | None, str | None]]) -> Block:
        numbers: dict[str, int] = {}
        items = []
        for item_id, text in rows:
            found = [numbers.setdefault(w, len(numbers)) for w in words_of(text)]
            if found:
                items.append((item_id, np.array(found, dtype=np.int64)))
        return Block(items, numbers)

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of the texts and where each text starts."""
        if self.memo is None:
            self.memo = Numbers(self.numbers)
        return self.memo.of(texts)


def least_score(words: int) -> int:
    """Score from which an alignment with an item of so many words is similar enough."""
    return MATCH * words if words < SHORT else max(1, math.ceil(SIMILARITY * MATCH * words - 1e-9))


@dataclass
class Seeds:
    """Of a block: the items whose seeds hold a word (by word number, ``first`` to the next), and
    for each item how many seeds an alignment holds (``need``), within how many words (``reach``),
    and the least ``3 c - l`` (``bound``) of the ``c`` seeds met in its ``l`` words."""
    first: np.ndarray
    item: np.ndarray
    need: np.ndarray
    reach: np.ndarray
    bound: np.ndarray
    words: np.ndarray        # item and word as one number, sorted: all words of the items
    least: np.ndarray        # least score of each item

    @staticmethod
    def of(block: Block, counts: np.ndarray) -> Seeds:
        n = np.array([len(x) for _, x in block.items])
        score = np.array([least_score(k) for k in n.tolist()])
        least = -(-score // MATCH)                       # matches, if none is paid for an edit
        need = np.maximum(1, (SEEDS * least).astype(np.int64))
        words = [np.unique(x[np.argsort(counts[x], kind="stable")][:k])
                 for (_, x), k in zip(block.items, (n - least + need).tolist())]
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words]).astype(np.min_scalar_type(len(words)))
        word = np.concatenate(words)
        first = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(block.numbers)))])
        # Edits cost 1 at least, so m matches in L words score 3 m - L at most, m <= n; of the
        # matches, all but the least - need most frequent words of the item are seeds.
        every = np.unique(np.repeat(np.arange(len(n)), n) * len(block.numbers) + np.concatenate([x for _, x in block.items]))
        return Seeds(first, owner[np.argsort(word, kind="stable")], need, 3 * n - score, score - 3 * (least - need), every, score)

    def candidates(self, numbers: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Text, item, start and end (in ``numbers``) of the parts to be aligned; parts that overlap are one.
        Texts are taken together as far as their seeds and their pairs with items are few enough."""
        at = np.flatnonzero(numbers >= 0)
        text = np.searchsorted(start, at, side="right") - 1
        hits = np.concatenate([[0], np.cumsum(self.first[numbers[at] + 1] - self.first[numbers[at]])])
        ends = np.searchsorted(at, start)                # of the texts, in ``at``
        k, texts, most = 0, len(start) - 1, max(1, PAIR_COUNTS // max(1, len(self.need)))
        while k < texts:
            last = int(np.searchsorted(hits[ends], hits[ends[k]] + HITS, side="right")) - 1
            last = min(max(last, k + 1), k + most, texts)
            some = slice(ends[k], ends[last])
            if ends[last] > ends[k]:
                yield from self.together(numbers, start, at[some], text[some], k, last)
            k = last

    def together(self, numbers: np.ndarray, start: np.ndarray, at: np.ndarray, text: np.ndarray, low: int, high: int):
        first = self.first[numbers[at]]
        n = self.first[numbers[at] + 1] - first
        total = int(n.sum())
        item = self.item[runs(first, n)]
        text, at = np.repeat(text, n), np.repeat(at, n)
        # an item that meets fewer seeds in all of a text than one alignment holds is not there
        pair = (text - low) * len(self.need) + item
        enough = np.bincount(pair, minlength=(high - low) * len(self.need)).reshape(high - low, -1) >= self.need
        held = enough.ravel()[pair]
        item, text, at = item[held], text[held], at[held]
        total = len(item)
        if not total:
            return
        order = np.argsort(item, kind="stable")          # by item, then by place in the texts
        item, text, at = item[order].astype(np.int64), text[order], at[order]
        # 3 c - l of the best stretch that ends at each seed: a running minimum, anew for each item and text.
        group = np.concatenate([[0], np.cumsum((item[1:] != item[:-1]) | (text[1:] != text[:-1]))])
        level = 3 * np.arange(total) - at - group * (3 * total + len(numbers) + 1)
        best = level - np.minimum.accumulate(level) + 2
        back = np.arange(total) - self.need[item] + 1
        held = np.maximum(back, 0)
        last = np.flatnonzero((best >= self.bound[item]) & (back >= 0) & (group[held] == group)
                              & (at - at[held] < self.reach[item]))
        if not len(last):
            return
        item, text, at, group = item[last], text[last], at[last], group[last]
        begin = np.maximum(at - self.reach[item] + 1, start[text])
        end = np.minimum(at + self.reach[item], start[text + 1])
        new = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (begin[1:] >= end[:-1])]))
        yield from zip(text[new].tolist(), item[new].tolist(), begin[new].tolist(),
                       end[np.append(new[1:], len(item)) - 1].tolist())


    def reaching(self, numbers: np.ndarray, todo: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Of the parts to be aligned those whose words, all of the item's that they hold taken for matches
        in the right order, reach the score that is asked for: 2 for each, -1 for any other word between."""
        kept, k = [], 0
        while k < len(todo):
            some, words = [], 0
            while k < len(todo) and (not some or words + todo[k][3] - todo[k][2] <= HITS):
                some.append(todo[k])
                words += todo[k][3] - todo[k][2]
                k += 1
            _, item, begin, end = np.array(some, dtype=np.int64).T
            n = end - begin
            word = numbers[runs(begin, n)]
            key = np.repeat(item, n) * (len(self.first) - 1) + word
            at = np.minimum(np.searchsorted(self.words, key), len(self.words) - 1)
            total = np.cumsum(np.where((word >= 0) & (self.words[at] == key), MATCH, -1))
            # the best stretch of each part: its running sum less the least before, anew for each part
            first = np.cumsum(n) - n
            before = np.concatenate([[0], total])[:-1]
            shift = np.repeat(np.arange(len(n)) * (3 * words + 1), n)
            best = total - (np.minimum.accumulate(before - shift) + shift)
            kept += [t for t, ok in zip(some, np.maximum.reduceat(best, first) >= self.least[item]) if ok]
        return kept


def align(items: list[np.ndarray], parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman score of each pair, and where in the part its alignment ends.

    Rows of the matrix go over the item, for all pairs at once; a gap along the part is a
    running maximum.
    """
    rows, width = max(map(len, items)), max(map(len, parts))
    item = np.full((len(items), rows), -2, dtype=np.int64)
    part = np.full((len(items), width), -3, dtype=np.int64)
    for k, (x, y) in enumerate(zip(items, parts)):
        item[k, :len(x)], part[k, :len(y)] = x, y
    slope = -GAP * np.arange(width, dtype=np.int32)
    above = np.zeros((len(items), width + 1), dtype=np.int32)
    best, end = np.zeros(len(items), dtype=np.int32), np.zeros(len(items), dtype=np.int64)
    for i in range(rows):
        step = np.where(item[:, i:i + 1] == part, np.int32(MATCH), np.int32(MISMATCH))
        cell = np.maximum(np.maximum(above[:, :-1] + step, above[:, 1:] + GAP), 0)
        above[:, 1:] = np.maximum.accumulate(cell + slope, axis=1) - slope
        at = above[:, 1:].argmax(axis=1)
        top = above[np.arange(len(items)), at + 1]
        better = top > best
        best[better], end[better] = top[better], at[better] + 1
    return best, end


def matches(block: Block, numbers: np.ndarray, starts: np.ndarray, seeds: Seeds) -> list[tuple[int, int, int, int, int]]:
    """Text, item, score, start and end word of the alignments that are similar enough."""
    todo = sorted(seeds.reaching(numbers, list(seeds.candidates(numbers, starts))), key=lambda t: t[2] - t[3])
    found, k = [], 0
    while k < len(todo):
        some = todo[k:k + max(1, min(PAIRS, CELLS // (todo[k][3] - todo[k][2])))]
        k += len(some)
        items = [block.items[i][1] for _, i, _, _ in some]
        parts = [numbers[a:b] for _, _, a, b in some]
        score, end = align(items, parts)
        good = [n for n, x in enumerate(items) if score[n] >= least_score(len(x))]
        if good:        # the same alignment from its end shows where it starts
            _, back = align([items[n][::-1] for n in good], [parts[n][:end[n]][::-1] for n in good])
            for n, m in zip(good, back.tolist()):
                r, i, a, _ = some[n]
                at = a - int(starts[r]) + int(end[n])
                found.append((r, i, int(score[n]), at - m, at))
    return found


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """Items in blocks, each read on its own."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    total, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    if total <= BLOCK_ITEMS and chars <= BLOCK_CHARS:
        yield Block.of(sorted(((r[0], r[1]) for r in items.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1])))
        return
    parts = max(-(-total * 5 // (4 * BLOCK_ITEMS)), -(-chars * 5 // (4 * BLOCK_CHARS)))
    spot = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        yield Block.of([(r[0], r[1]) for r in items.where(spot == k).orderBy("item_id", "text").collect()])


def word_rows(docs: DataFrame, block: Broadcast) -> DataFrame:
    """``doc_id`` and word numbers of the documents that hold a word of the block."""
    out = pa.schema([("doc_id", pa.int64()), ("words", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers, start = block.value.read(b.column(1))
            words = pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(numbers))
            known = np.concatenate([[0], np.cumsum(numbers >= 0)])[start]
            yield pa.RecordBatch.from_arrays([b.column(0), words], schema=out).filter(pa.array(known[1:] > known[:-1]))

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, words array<int>"))


def seeds_of(rows: DataFrame, block: Block, shared: Broadcast) -> Broadcast:
    """The block's seeds by how often each of its words occurs in ``rows``: texts, or their word numbers."""
    out = pa.schema([("word", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value.numbers), dtype=np.int64)
        for b in batches:
            if pa.types.is_list(b.column(0).type):
                x = b.column(0).flatten().to_numpy()
            else:
                x = shared.value.read(b.column(0))[0]
            total += np.bincount(x[x >= 0], minlength=len(total))
        some = np.flatnonzero(total)
        yield batch_of(out, [some, total[some]])

    counts = np.zeros(len(block.numbers), dtype=np.int64)
    for r in rows.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        counts[r["word"]] = r["n"]
    return rows.sparkSession.sparkContext.broadcast(Seeds.of(block, counts))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``similarity``, ``score``, ``item_words``, ``start_word``, ``end_word``:
    one row for each document and item that share a similar passage."""
    schema = "doc_id long, item_id long, score long, item_words long, start_word long, end_word long"
    out = pa.schema([(x.split()[0], pa.int64()) for x in schema.split(", ")])
    result = docs.sparkSession.createDataFrame([], schema)

    def aligned(shared: Broadcast, seeds: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                block, ids = shared.value, b.column(0).to_pylist()
                start = b.column(1).offsets.to_numpy().astype(np.int64)
                found = [(ids[r], block.items[i][0], score, len(block.items[i][1]), begin, end)
                         for r, i, score, begin, end in matches(
                             block, b.column(1).flatten().to_numpy(), start - start[0], seeds.value)]
                if found:
                    yield batch_of(out, list(zip(*found)))
        return run

    for block in blocks(benchmark):
        if block.items:
            shared = docs.sparkSession.sparkContext.broadcast(block)
            words = stored(word_rows(docs, shared))
            seeds = seeds_of(words.select("words"), block, shared)
            result = result.unionByName(words.mapInArrow(aligned(shared, seeds), schema))
    best = F.max_by(F.struct("item_words", "start_word", "end_word"), F.struct("score", -F.col("start_word"), "item_words"))
    return (result.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), best.alias("at"))
            .select("doc_id", "item_id", (F.col("score") / (MATCH * F.col("at.item_words"))).alias("similarity"),
                    "score", "at.item_words", "at.start_word", "at.end_word"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that share no similar passage with any item, judged where they are: each block
    counts its words in all rows, then one pass over the rows judges them by all blocks."""
    texts = docs.select("text")
    at = docs.columns.index("text")

    def keep(shared: Broadcast, seeds: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                block = shared.value
                bad = {m[0] for m in matches(block, *block.read(b.column(at)), seeds.value)}
                yield b.filter(pa.array([k not in bad for k in range(len(b))]))
        return run

    for block in blocks(benchmark):
        if block.items:
            shared = docs.sparkSession.sparkContext.broadcast(block)
            seeds = seeds_of(texts, block, shared)
            docs = docs.mapInArrow(keep(shared, seeds), docs.schema)
    return docs
