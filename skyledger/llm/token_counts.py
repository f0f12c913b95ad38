"""Token counts by whole-token lookup; only the other pre-tokens are merged."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.byte_level import (
    Vocabulary,
    load_vocabulary,
    pre_tokens,
    read_vocabulary_file,
)
from skyledger.llm.common import slices, texts_of

# Merged pre-tokens whose count a worker keeps; a full table is emptied.
KEPT_WORDS = 800_000
LIMIT = 1024


class Counter:
    """Counts tokens of texts.

    `whole` holds the pre-tokens that are one token, proven for each vocabulary string on its
    own: it is valid text, the splitter leaves it in one piece, and the merges applied to its
    bytes end in that single token.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self._ranks = {(a, b): (rank, made) for rank, (a, b, made) in enumerate(vocabulary.merges)}
        special = set(vocabulary.special.values())
        self._bytes = {label[0]: token for token, label in vocabulary.labels.items()
                       if len(label) == 1 and token not in special}
        self._merged: dict[str, int] = {}
        self.whole = {text for token, label in vocabulary.labels.items() if token not in special
                      for text in [self._proven(token, label)] if text is not None}

    def _proven(self, token: int, label: bytes) -> str | None:
        try:
            text = label.decode()
        except UnicodeDecodeError:
            return None
        alone = pre_tokens(text) == [text] and self.merge(label) == [token]
        return text if alone else None

    def merge(self, word: bytes) -> list[int]:
        """The tokens of one pre-token: the merge of lowest rank first, leftmost first."""
        parts, ranks = [self._bytes[byte] for byte in word], self._ranks
        if len(parts) > 64:
            return self._merge_long(parts)
        while len(parts) > 1:
            best = min(map(ranks.get, zip(parts, parts[1:], strict=False)), default=None,
                       key=lambda found: found[0] if found else len(ranks))
            if best is None:
                break
            parts = self._joined(parts, best)
        return parts

    def _joined(self, parts: list[int], best: tuple[int, int]) -> list[int]:
        left, right, made = self.vocabulary.merges[best[0]]
        found, at, last = [], 0, len(parts) - 1
        while at <= last:
            if at < last and parts[at] == left and parts[at + 1] == right:
                found.append(made)
                at += 2
            else:
                found.append(parts[at])
                at += 1
        return found

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same for a very long pre-token: a heap of pairs over a linked list."""
        from heapq import heapify, heappop, heappush

        ranks, size = self._ranks, len(parts)
        after = [*range(1, size), -1]
        before = [-1, *range(size - 1)]
        heap = [(ranks[pair][0], i) for i, pair in enumerate(zip(parts, parts[1:], strict=False))
                if pair in ranks]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if parts[i] < 0 or j < 0 or ranks.get((parts[i], parts[j]), (-1,))[0] != rank:
                continue
            parts[i], parts[j] = ranks[parts[i], parts[j]][1], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (parts[a], parts[b]) in ranks:
                    heappush(heap, (ranks[parts[a], parts[b]][0], a))
        return [part for part in parts if part >= 0]

    def _rest(self, word: str) -> int:
        found = self._merged.get(word)
        if found is None:
            if len(self._merged) >= KEPT_WORDS:
                self._merged.clear()
            found = self._merged[word] = len(self.merge(word.encode()))
        return found

    def count(self, text: str) -> int:
        total, whole = 0, self.whole
        for part, special in self.vocabulary.parts(text):
            if special is not None:
                total += 1
                continue
            words = pre_tokens(part)
            rest = [word for word in words if word not in whole]
            total += len(words) - len(rest) + sum(map(self._rest, rest))
        return total


@lru_cache(maxsize=2)
def prepared(source: str) -> Counter:
    """The counter of a vocabulary file's text, once for each worker process."""
    return Counter(load_vocabulary(source))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text.

    `docs` has doc_id and text; other columns are not read, whatever their names. One row
    for each input row, repeats included. A null or empty text has no bytes and no tokens. An
    empty table gives an empty result. A special string inside a text is one token. A very
    long text is one piece of work, in memory that is a small multiple of its length.
    """
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary_file(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prepared(source.value)
        for batch in slices(batches):
            counts = [counter.count(text) for text in texts_of(batch)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"),
                "n_tokens": pa.array(counts, pa.int64())})

    size = F.octet_length(F.coalesce(docs["text"], F.lit(""))).cast("bigint")
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"),
                       size.alias("n_bytes"), docs["text"].alias("text"))
    counted = rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
