"""An interpolated modified Kneser-Ney bigram model, counted in Spark and scored from disk.

Words are 64-bit hashes. A task cuts its texts, counts its bigrams and sends each shard one
sorted block of them; a shard merges the blocks it gets, so no task holds more than a shard.
Bigrams are dealt to shards by context and a few bits of the next word: a context with a
third of all words is spread over many shards. What a shard finds out about a word (how often
it is a context, how many different words precede and follow it) is added up by word.

The model is two sorted arrays for each shard, keys and numbers, in the shared folder. Workers
map them into memory and look up the distinct, sorted n-grams of a batch, so the pages they
touch are read in order and can be dropped again at any time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import bucket_of, slices, texts_of
from skyledger.llm.hashing import BASE, ODD, Shards, grouped, mapped, mix, word_hashes, write_table
from skyledger.session import fresh_folder

# Tokens that a task counts before it sends its blocks, and tokens for each shard. Both bound what
# a task holds (about 120 bytes a token); raise them with the memory and the size of the corpus.
TASK_TOKENS, SHARD_TOKENS = 1_000_000, 1_000_000
# Shards that words are dealt to, at most: each shard of bigrams sends every one of them a block, so
# their number must not grow with the input. A vocabulary of 10^9 words has 8 MB in each.
WORD_SHARDS = 4096
# The bigrams of one context go to up to this many shards.
SPREAD = 16
# Bytes of text that are cut into words at once, and tokens that are looked up at once.
CUT_BYTES = 1 << 20
BATCH_TOKENS = 400_000

END, START = np.uint64(1), np.uint64(2)
WORD = np.dtype([("count", "<u8"), ("before", "<u4"), ("n1", "<u4"), ("n2", "<u4"),
                 ("n3", "<u4")])
KEYED = np.dtype([("key", "<u8"), *WORD.descr])


def tokens_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' words, an END behind each text; and the tokens of each text.

    Words are cut at ASCII white space after A-Z are lower-cased.
    """
    parts = [text.encode() for text in texts]
    data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    starts, words = word_hashes(data)
    text_ends = np.cumsum(np.array([len(part) + 1 for part in parts], np.int64))
    before = np.searchsorted(starts, text_ends)
    return np.insert(words, before, END), np.diff(before, prepend=0) + 1


def _contexts(tokens: np.ndarray, sizes: np.ndarray, start=START) -> np.ndarray:
    """The token before each token; `start` for the first of a text."""
    found = np.empty_like(tokens)
    found[1:] = tokens[:-1]
    found[np.cumsum(sizes) - sizes] = start
    return found


def _pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * np.uint64(ODD) + word)


def _shard(context: np.ndarray, word: np.ndarray, shards: int) -> np.ndarray:
    spread = mix(word ^ np.uint64(BASE)) % np.uint64(SPREAD)
    return (mix(context + spread * np.uint64(ODD)) % np.uint64(shards)).astype(np.int64)


def _word_shard(word: np.ndarray, shards: int) -> np.ndarray:
    return (mix(word + np.uint64(BASE)) % np.uint64(shards)).astype(np.int64)


def _pack_pairs(context: np.ndarray, word: np.ndarray, n: np.ndarray) -> bytes:
    """Bigrams in order of context: contexts once with their run lengths, words, small counts."""
    at = np.flatnonzero(np.diff(context, prepend=~context[:1])) if len(context) else context[:0]
    runs = np.diff(np.append(at, len(context))).astype("<u4")
    large = np.flatnonzero(n >= 255)
    header = np.array([len(at), len(word), len(large)], "<u8")
    return b"".join([
        header.tobytes(), context[at.astype(np.int64)].tobytes(), runs.tobytes(), word.tobytes(),
        np.minimum(n, 255).astype(np.uint8).tobytes(), large.astype("<u4").tobytes(),
        n[large].astype("<u8").tobytes()])


def _unpack_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    heads, rows, large = (int(x) for x in np.frombuffer(blob, "<u8", 3))
    at = 24

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(blob, kind, count, at)
        at += found.nbytes
        return found

    context = np.repeat(take("<u8", heads), take("<u4", heads))
    word, n = take("<u8", rows), take("u1", rows).astype(np.int64)
    where = take("<u4", large)
    n[where] = take("<u8", large)
    return context, word, n


def _blocks(shards: int):
    """(shard, block) rows of the bigrams of a task's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = 0, []

        def flush() -> pa.RecordBatch:
            keys = [np.concatenate([p[i] for p in parts]) for i in (0, 1)]
            (context, word), (n,) = grouped(keys, [np.ones(len(keys[0]), np.int64)])
            home = _shard(context, word, shards)
            order = np.argsort(home, kind="stable")
            at = np.flatnonzero(np.diff(home[order], prepend=-1))
            names = home[order[at]]
            blobs = [_pack_pairs(context[rows], word[rows], n[rows])
                     for rows in (np.split(order, at[1:]) if len(at) else [])]
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), pa.array(blobs, pa.binary())],
                names=["shard", "block"])

        for batch in slices(batches, most=CUT_BYTES):
            tokens, sizes = tokens_of(texts_of(batch))
            parts.append((_contexts(tokens, sizes), tokens))
            held += len(tokens)
            if held >= TASK_TOKENS:
                yield flush()
                held, parts = 0, []
        if parts:
            yield flush()
    return run


def _merge_pairs(folder: str, word_shards: int):
    """Write each shard's bigram counts; pass on what they say about words, by word shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []

        def finish() -> Iterator[pa.RecordBatch]:
            (context, word), (n,) = grouped(
                [np.concatenate([p[i] for p in parts]) for i in (0, 1)],
                [np.concatenate([p[2] for p in parts])])
            pairs = _pair_key(context, word)
            order = np.argsort(pairs)
            write_table(folder, f"pairs-{shard}", pairs[order], n[order].astype(
                np.min_scalar_type(n.max()).newbyteorder("<")))
            ones = [(n == 1), (n == 2), (n >= 3)]
            (heads,), sums = grouped([context], [n, *ones])
            (tails,), (before,) = grouped([word], [np.ones(len(word), np.int64)])
            words = np.zeros(len(heads) + len(tails), KEYED)
            first = words[:len(heads)]
            first["key"] = heads
            for name, values in zip(("count", "n1", "n2", "n3"), sums, strict=True):
                first[name] = values
            words["key"][len(heads):], words["before"][len(heads):] = tails, before
            home = _word_shard(words["key"], word_shards)
            order = np.argsort(home, kind="stable")
            words, home = words[order], home[order]
            at = np.flatnonzero(np.diff(home, prepend=-1))  # shards that get any word
            ends = np.append(at[1:], len(words))
            kinds = [int((n == k).sum()) for k in range(1, 5)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(home[at], pa.int32()),
                 pa.array([words[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary()),
                 pa.array([kinds] + [[0] * 4] * (len(at) - 1), pa.list_(pa.int64())),
                 pa.array([int(n.sum())] + [0] * (len(at) - 1), pa.int64())],
                names=["shard", "block", "kinds", "tokens"])

        for batch in batches:
            for name, blob in zip(batch.column("shard").to_pylist(), batch.column("block"),
                                  strict=True):
                if name != shard and parts:
                    yield from finish()
                    parts = []
                shard = name
                parts.append(_unpack_pairs(blob.as_buffer().to_pybytes()))
        if parts:
            yield from finish()
    return run


def _merge_words(folder: str):
    """Write each shard's table of words; return its totals and those that came with the blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, tokens, pairs = None, [], 0, np.zeros(4, np.int64)

        def finish() -> pa.RecordBatch:
            rows = np.concatenate(parts)
            names = ("count", "before", "n1", "n2", "n3")
            (keys,), sums = grouped([rows["key"]], [rows[name] for name in names])
            table = np.zeros(len(keys), WORD)
            for name, values in zip(names, sums, strict=True):
                table[name] = values
            write_table(folder, f"words-{shard}", keys, table)
            before, real = table["before"], keys != START
            kinds = [int((before[real] == k).sum()) for k in range(1, 5)]
            return totals(int(real.sum()), int(before.sum()), kinds, 0, [0] * 4)

        def totals(words, before, word_kinds, tokens, pair_kinds) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "words": pa.array([words], pa.int64()), "before": pa.array([before], pa.int64()),
                "word_kinds": pa.array([word_kinds], pa.list_(pa.int64())),
                "tokens": pa.array([tokens], pa.int64()),
                "pair_kinds": pa.array([pair_kinds], pa.list_(pa.int64()))})

        for batch in batches:
            tokens += sum(batch.column("tokens").to_pylist())
            pairs += np.array(batch.column("kinds").to_pylist(), np.int64).reshape(-1, 4).sum(axis=0)
            for name, blob in zip(batch.column("shard").to_pylist(), batch.column("block"),
                                  strict=True):
                if name != shard and parts:
                    yield finish()
                    parts = []
                shard = name
                parts.append(np.frombuffer(blob.as_buffer().to_pybytes(), KEYED))
        if parts:
            yield finish()
        yield totals(0, 0, [0] * 4, tokens, pairs.tolist())
    return run


def discounts(kinds: list[int]) -> np.ndarray:
    """The discounts for counts 0, 1, 2 and 3 or more, from how many n-grams occur 1 to 4 times.

    Where too few n-grams make the usual estimate impossible, a fixed share is taken instead.
    """
    n1, n2, n3, n4 = kinds
    found = [0.0, 0.5, 0.75, 0.9]
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        found[1] = 1 - 2 * y * n2 / n1
        found[2] = 2 - 3 * y * n3 / n2
        found[3] = 3 - 4 * y * n4 / n3 if n3 else found[2]
    return np.array([0.0, *(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found[1:], 1))])


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the totals that the formulas need."""

    folder: str
    shards: int
    word_shards: int
    tokens: int
    words: int
    before: int
    pair_kinds: tuple[int, ...]
    word_kinds: tuple[int, ...]


def fit(docs: DataFrame) -> Model:
    """Count the bigrams of all texts of `docs` and write the model to the shared folder."""
    spark = docs.sparkSession
    folder = fresh_folder(spark, "bigrams")
    texts = docs.select(F.coalesce(docs["text"], F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    shards = max(8, math.ceil(size / (6 * SHARD_TOKENS)))
    word_shards = min(shards, WORD_SHARDS)
    blocks = texts.mapInArrow(_blocks(shards), "shard int, block binary")
    merged = (blocks.repartition(shards, "shard").sortWithinPartitions("shard")
              .mapInArrow(_merge_pairs(folder, word_shards),
                          "shard int, block binary, kinds array<bigint>, tokens bigint"))
    totals = (merged.repartition(word_shards, "shard").sortWithinPartitions("shard")
              .mapInArrow(_merge_words(folder), "words bigint, before bigint, "
                          "word_kinds array<bigint>, tokens bigint, pair_kinds array<bigint>"))

    def total(value: Column | str) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    found = totals.agg(
        total("tokens"), total("words"), total("before"),
        *(total(F.get("pair_kinds", F.lit(k))) for k in range(4)),
        *(total(F.get("word_kinds", F.lit(k))) for k in range(4))).first()
    return Model(folder, shards, word_shards, *found[:3], tuple(found[3:7]), tuple(found[7:]))


class Scorer:
    """Looks n-grams up in the mapped arrays."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._pair_cuts, self._word_cuts = discounts(model.pair_kinds), discounts(model.word_kinds)
        self._shards = Shards(self._read)
        start = np.array([START])
        # every text has one start and one end, and only starts are counted as contexts
        self._ends = int(self._look_up("words", start, _word_shard(
            start, model.word_shards))["count"][0])

    def _read(self, wanted: tuple[str, int]) -> tuple[np.ndarray, np.ndarray]:
        name, shard = wanted
        keys = mapped(self.model.folder, f"{name}-{shard}.keys", np.dtype("<u8"))
        rows = mapped(self.model.folder, f"{name}-{shard}.rows",
                      WORD if name == "words" else np.dtype("u1"))
        if name == "pairs" and len(keys):  # counts take as few bytes as their largest needs
            rows = rows.view(f"<u{len(rows) // len(keys)}")
        return keys, rows

    def _look_up(self, name: str, keys: np.ndarray, homes: np.ndarray) -> np.ndarray:
        """The row of each key; zeros for a key that training did not see."""
        found = np.zeros(len(keys), WORD if name == "words" else "<u8")
        order = np.lexsort((keys, homes))
        at = np.flatnonzero(np.diff(homes[order], prepend=-1))
        for rows in np.split(order, at[1:]) if len(at) else []:
            shard = int(homes[rows[0]])
            known, values = self._shards[name, shard]
            if not len(known):
                continue
            wanted = keys[rows]
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            hit = known[at] == wanted
            found[rows[hit]] = values[at[hit]]
        return found

    def log_probabilities(self, tokens: np.ndarray, sizes: np.ndarray):
        """log10 of the model's and of the base probability of each token, and whether known."""
        model = self.model
        names, where = np.unique(np.append(tokens, START), return_inverse=True)
        w = where[:-1]
        c = _contexts(w, sizes, where[-1])
        rows = self._look_up("words", names, _word_shard(names, model.word_shards))
        before = rows["before"].astype(np.int64)
        lower = np.full(len(names), 1.0 / (model.words + 1))
        if model.before:
            cut, (once, twice) = self._word_cuts, model.word_kinds[:2]
            left = cut[1] * once + cut[2] * twice + cut[3] * (model.words - once - twice)
            lower = (np.maximum(before - cut[np.minimum(before, 3)], 0.0)
                     + left / (model.words + 1)) / model.before
        context, cut = names[c], self._pair_cuts
        n = self._look_up("pairs", _pair_key(context, tokens),
                          _shard(context, tokens, model.shards)).astype(np.int64)
        seen = rows["count"].astype(np.float64)
        spared = cut[1] * rows["n1"] + cut[2] * rows["n2"] + cut[3] * rows["n3"]
        share = np.where(seen > 0, spared / np.maximum(seen, 1), 1.0)
        own = np.maximum(n - cut[np.minimum(n, 3)], 0.0) / np.maximum(seen, 1)[c]
        count = np.where(names == END, self._ends, rows["count"]).astype(np.float64)
        base = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.words + 1)))
        return np.log10(own + share[c] * lower[w]), base[w], count[w] > 0


@lru_cache(maxsize=1)
def _scorer(model: Model) -> Scorer:
    return Scorer(model)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score and perplexity of every text.

    `docs` has doc_id and text; other columns are not read, whatever their names. One row for
    each input row, repeats included. A null or empty text is its end alone, one token. A word
    that training did not see has the probability that discounting left over, shared equally. A
    model of no texts gives every token probability 1. A very long text is scored whole, as one piece of
    a batch. An empty table gives an empty result.
    """
    def scored(scorer: Scorer, parts: list) -> pa.RecordBatch:
        ids = [doc for found, _, _ in parts for doc in found]
        tokens, sizes = (np.concatenate([part[i] for part in parts]) for i in (1, 2))
        logs, base, known = scorer.log_probabilities(tokens, sizes)
        at = np.cumsum(sizes) - sizes
        scores = np.add.reduceat(logs, at)
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()), "n_tokens": pa.array(sizes.astype(np.int64)),
            "n_known": pa.array(np.add.reduceat(known.astype(np.int64), at)),
            "train_tokens": pa.array(np.full(len(sizes), model.tokens, np.int64)),
            "base_score": pa.array(np.add.reduceat(base, at)), "score": pa.array(scores),
            "perplexity": pa.array(10.0 ** np.minimum(-scores / sizes, 300.0))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, parts, held = _scorer(model), [], 0
        for batch in slices(batches, most=CUT_BYTES):
            parts.append((batch.column("doc_id").to_pylist(), *tokens_of(texts_of(batch))))
            held += len(parts[-1][1])
            if held >= BATCH_TOKENS:
                yield scored(scorer, parts)
                parts, held = [], 0
        if parts:
            yield scored(scorer, parts)

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"),
                       F.coalesce(docs["text"], F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, n_known bigint, "
                                "train_tokens bigint, base_score double, score double, "
                                "perplexity double")


def score_held_out(docs: DataFrame) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out fifth."""
    found = score(docs, fit(docs.where(bucket_of("doc_id", 5) != 1)))
    return found.select("doc_id", (bucket_of("doc_id", 5) == 1).alias("held_out"), "n_tokens",
                        "n_known", "train_tokens", "base_score", "score", "perplexity")
