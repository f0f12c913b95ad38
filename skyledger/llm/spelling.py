"""Spelling variants: words that differ by one letter, each pointed to its commonest neighbour.

Every text that one deletion or replacement makes out of a word is tested against Bloom filters
of the vocabulary, one for each word length, which are broadcast; a neighbour by insertion is the
other end of a deletion. The hash of an edit follows from that of the word in one step, and
an edit becomes a text only if a filter lets it pass. These go to an exact join with the vocabulary,
which removes false positives.

A filter consists of blocks of 512 bits, so that a test reads one place of memory. All filters
of a round take `FILTER_BYTES` at most: a larger vocabulary is divided by hash into several
rounds, each of which tests only the edits of its own part.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import materialize, slices, texts_of
from skyledger.llm.hashing import BASE, ODD, mix

# Which words count, how much more frequent a form is, and how words are damaged.
LEAST_LENGTH, LEAST_COUNT, FACTOR, DAMAGED = 6, 5, 5, 199
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)

# Lengths from this one on share a filter.
LONGEST = 48
BITS_A_WORD, BITS_SET, BLOCK = 16, 6, 8
FILTER_BYTES = 32 << 20
# Distinct words a task counts before it sends them, and edits that are tested at once.
COUNTED, TESTED = 1 << 20, 1 << 19
# Words for each task of the search.
TASK_WORDS = 20_000

_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")


def damaged(doc_id: int | None, run: str) -> str:
    """The run, without one letter if the hash of document and run says so."""
    hit = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if hit % DAMAGED:
        return run
    at = hit % len(run)
    return run[:at] + run[at + 1:]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pydict({
            "word": pa.array(seen.keys(), pa.string()), "n": pa.array(seen.values(), pa.int64())})
        seen.clear()
        return batch

    for batch in slices(batches):
        ids = batch.column("doc_id").to_pylist()
        for doc, text in zip(ids, texts_of(batch), strict=True):
            start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            # bytes.lower knows the letters A-Z only
            runs = Counter(_RUN.findall(text.encode().lower().decode()))
            hits = [run for run in runs if not zlib.crc32(run.encode(), start) % DAMAGED]
            for run in hits:
                shorter = damaged(doc, run)
                if len(shorter) >= LEAST_LENGTH:
                    seen[shorter] += runs[run]
                del runs[run]
            seen.update(runs)
        if len(seen) >= COUNTED:
            yield flush()
    yield flush()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n of the words that are long and frequent enough, over all documents."""
    counted = docs.select(docs["doc_id"], docs["text"]).mapInArrow(_counts, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _powers(size: int) -> np.ndarray:
    powers = np.full(size, BASE, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _sums(letters: np.ndarray) -> np.ndarray:
    """Hash of a word of each row of letters: before mixing, so that edits can be added."""
    return (letters * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


def _mixed(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + np.uint64(length * ODD % (1 << 64)))


def _letters(words: list[str]) -> np.ndarray:
    """Code points, which are below 256, of words of one length."""
    data = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return data.reshape(len(words), -1).astype(np.uint64)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the words of each length."""
    lengths = np.array([len(word) for word in words], np.int64)
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


def _places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The first slot of each hash's block, and nine bits for each place in the block."""
    first = (hashes >> np.uint64(24)) % np.uint64(blocks) * np.uint64(BLOCK)
    return first.astype(np.int64), mix(hashes ^ np.uint64(ODD))


def _bit(first: np.ndarray, places: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """(slot, shift) of one of the bits of each hash."""
    place = places >> np.uint64(9 * bit)
    return (first + (place & np.uint64(BLOCK - 1)).astype(np.int64),
            (place >> np.uint64(3)) & np.uint64(63))


def _shard(length: int) -> int:
    return min(length, LONGEST)


class Filters:
    """Which words of one part of the vocabulary may exist; a filter for each length."""

    def __init__(self, sizes: dict[int, int], part: int, parts: int) -> None:
        self.part, self.parts = part, parts
        self.blocks = {shard: 1 + count * BITS_A_WORD // (64 * BLOCK * parts)
                       for shard, count in sizes.items()}
        self.slots: dict[int, np.ndarray] = {}

    def own(self, hashes: np.ndarray) -> np.ndarray:
        return hashes % np.uint64(self.parts) == np.uint64(self.part)

    def entries(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for length, at in _by_length(words):
                hashes = _mixed(_sums(_letters([words[i] for i in at])), length)
                blocks = self.blocks[_shard(length)]
                first, places = _places(hashes[self.own(hashes)], blocks)
                for bit in range(BITS_SET):
                    slots, shifts = _bit(first, places, bit)
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array(np.full(len(slots), _shard(length), np.int32)),
                        "slot": pa.array(slots),
                        "mask": pa.array((np.uint64(1) << shifts).view(np.int64))})

    def fill(self, words: DataFrame) -> None:
        """Gather the filters; their size is bounded by FILTER_BYTES."""
        rows = words.select("word").mapInArrow(
            self.entries, "shard int, slot bigint, mask bigint")
        found = rows.groupBy("shard", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()
        shards, slots = found["shard"].to_numpy(), found["slot"].to_numpy()
        masks = found["mask"].to_numpy().view(np.uint64)
        for shard, blocks in self.blocks.items():
            self.slots[shard] = np.zeros(blocks * BLOCK, np.uint64)
            own = shards == shard
            self.slots[shard][slots[own]] = masks[own]

    def may_have(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Places of the hashes that the filter of a length lets pass."""
        shard = _shard(length)
        if shard not in self.slots:
            return np.zeros(0, np.int64)
        at = np.flatnonzero(self.own(hashes))
        first, places = _places(hashes[at], self.blocks[shard])
        for bit in range(BITS_SET):  # each bit is tested for what the last one left
            slots, shifts = _bit(first, places, bit)
            left = np.flatnonzero((self.slots[shard][slots] >> shifts) & np.uint64(1))
            at, first, places = at[left], first[left], places[left]
        return at


def _search(filters):
    """(word, n, edit) of the edits that the filters let pass."""
    def edits(words: list[str], length: int) -> Iterator[tuple[np.ndarray, list[str]]]:
        letters = _letters(words)
        powers, sums = _powers(length), _sums(letters)
        known = filters.value
        # all positions, or those that TESTED allows
        step = max(1, TESTED // (len(words) * len(ALPHABET)))
        before = np.zeros(len(words), np.uint64)
        back = np.uint64(pow(BASE, -1, 1 << 64))
        for first in range(0, length, step):
            part = letters[:, first:first + step]
            terms = part * powers[first:first + step]
            # without the letter, those behind it move up by one place
            left = before[:, None] + np.cumsum(terms, axis=1, dtype=np.uint64)
            shorter = left - terms + (sums[:, None] - left) * back
            before = left[:, -1]
            ahead = letters[:, max(first - 1, 0):first + part.shape[1] - 1]
            fresh = np.ones(part.shape, bool)  # of equal letters in a row the first one goes
            fresh[:, part.shape[1] - ahead.shape[1]:] = part[:, part.shape[1] - ahead.shape[1]:] != ahead
            row, at = np.nonzero(fresh)
            hit = known.may_have(_mixed(shorter[row, at], length - 1), length - 1)
            yield row[hit], [words[r][:first + a] + words[r][first + a + 1:]
                             for r, a in zip(row[hit], at[hit], strict=True)]
            # of two words that differ in one letter, the one with the smaller letter asks
            row, at, letter = np.nonzero(ALPHABET > part[:, :, None])
            change = (ALPHABET[letter] - part[row, at]) * powers[first + at]
            hit = known.may_have(_mixed(sums[row] + change, length), length)
            yield row[hit], [words[r][:first + a] + chr(int(ALPHABET[c])) + words[r][first + a + 1:]
                             for r, a, c in zip(row[hit], at[hit], letter[hit], strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for length, at in _by_length(words):
                size = max(1, TESTED // (length * len(ALPHABET)))
                for first in range(0, len(at), size):
                    piece = at[first:first + size]
                    for rows, texts in edits([words[i] for i in piece], length):
                        if len(rows):
                            yield pa.RecordBatch.from_pydict({
                                "word": pa.array([words[i] for i in piece[rows]], pa.string()),
                                "n": pa.array(counts[piece[rows]]),
                                "edit": pa.array(texts, pa.string())})
    return run


def near_words(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: every pair of words (word, n) one deletion or replacement apart, once.

    `words` has each word once, of code points below 256. An empty table gives an empty result.
    """
    spark = words.sparkSession
    shard = F.least(F.char_length("word"), F.lit(LONGEST))
    sizes = {row[0]: row[1] for row in words.groupBy(shard).count().collect()}
    total = sum(sizes.values())
    parts = max(1, math.ceil(total * BITS_A_WORD / 8 / FILTER_BYTES))
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(total / TASK_WORDS))
    found = None
    for part in range(parts):
        filters = Filters(sizes, part, parts)
        filters.fill(words)
        passed = words.repartition(tasks).mapInArrow(
            _search(spark.sparkContext.broadcast(filters)), "word string, n bigint, edit string")
        if parts > 1:  # one filter is in memory at a time
            passed = materialize(passed, "edits")
        found = passed if found is None else found.unionAll(passed)
    other = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    return found.join(other, found["edit"] == other["b"]).select(
        F.col("word").alias("a"), F.col("n").alias("a_n"), "b", "b_n")


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """word and root of every word with a form, by doubling the way that is known.

    A form is FACTOR times as frequent as its word, so a way has few steps.
    """
    steps = math.log(max(most, 1), FACTOR) + 1
    ways = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        ways = materialize(ways, "roots")
        further = ways.select(F.col("word").alias("at"), F.col("root").alias("to"))
        ways = ways.join(further, ways["root"] == further["at"], "left").select(
            "word", F.coalesce("to", "root").alias("root"))
    return ways


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    Words are runs of a-z and the letters from U+00C0 to U+00FF, after A-Z are lower-cased; now
    and then one loses a letter (`damaged`). Those of LEAST_LENGTH letters that occur
    LEAST_COUNT times are the vocabulary. n_near: words that differ in one inserted, deleted or
    replaced letter. form: the most frequent of them, the least one of several, if it is FACTOR
    times as frequent; root: the last word on the way from form to form.

    `docs` has doc_id and text; other columns are not read. A null text has no words, a null doc_id
    counts as an empty one in `damaged`. Repeated rows count as often as they stand there. Very
    long texts are read whole, very long words edited piece by piece. An empty table gives an
    empty result.
    """
    words = materialize(vocabulary(docs), "vocabulary")
    pairs = materialize(near_words(words), "near-words")
    both = pairs.unionAll(pairs.select("b", "b_n", "a", "a_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form")))
    near = both.groupBy("a").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, words["word"] == near["a"], "left")
    enough: Column = -F.col("best.less") >= FACTOR * F.col("n")
    rows = materialize(joined.select(
        "word", F.when(enough, F.col("best.form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n")), "variants")
    most = words.agg(F.max("n")).first()[0] or 1
    roots = _roots(rows.where("form is not null"), most).withColumnRenamed("word", "at")
    return rows.join(roots, rows["word"] == roots["at"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
