"""BPE encoding and decoding by an automaton over tokens.

The automaton starts with one state and an arc back to it for each byte. Each merge (u, v)
adds one gadget: the state that u leads to is replaced, for u alone, by a copy without the
arc v, so that "u then v" can no longer be read, and an arc for the merged token leaves every
state that had both. The paths that remain spell exactly the token sequences that the merges
produce, one for each string, and every state accepts.

States are stored as what each gadget took away: `cut` holds the time at which the state
after u lost its arc v, and a merged token's state starts as that of its right part at that
time. An arc of a merged token exists where the arc of its left part did at that time. So the
table has one entry for each merge instead of one for each pair of states and tokens, and
looked-up arcs are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm.byte_level import (
    Vocabulary,
    load_vocabulary,
    pre_tokens,
    read_vocabulary_file,
)
from skyledger.llm.common import slices, texts_of

# Entries a task keeps of arcs and of encoded words; a full table is emptied.
KEPT_ARCS = 200_000
KEPT_WORDS = 200_000
_ALWAYS = 1 << 60


class Automaton:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.labels = vocabulary.labels
        self.cut: dict[tuple[int, int], int] = {}
        self.state_from: dict[int, tuple[int, int]] = {}
        self.starts_with: dict[int, tuple[int, int]] = {}
        self._arcs: dict[tuple[int, int], bool] = {}
        self._words: dict[str, tuple[int, ...]] = {}
        special = set(vocabulary.special.values())
        made = {merged for _, _, merged in vocabulary.merges}
        bases = [t for t in self.labels if t not in made and t not in special]
        if any(len(self.labels[t]) != 1 for t in bases):
            raise ValueError("a token that no merge makes is longer than one byte")
        self.tokens = {self.labels[t]: t for t in bases}
        for time, (left, right, merged) in enumerate(vocabulary.merges):
            self._add_gadget(time, left, right, merged)
        self._longest: dict[bytes, int] = {}
        for label in self.tokens:
            for head in (label[:1], label[:2]):
                self._longest[head] = max(self._longest.get(head, 0), len(label))

    def _add_gadget(self, time: int, left: int, right: int, merged: int) -> None:
        if merged in self.state_from:
            raise ValueError("two merges make the same token")
        reached = all(self.tokens.get(self.labels[t]) == t for t in (left, right))
        readable = reached and self._exists(left, right)
        self.cut[left, right] = time
        self.state_from[merged] = (right, time)
        self.starts_with[merged] = (left, time)
        if readable:
            self.tokens[self.labels[merged]] = merged

    def _exists(self, before: int, token: int) -> bool:
        """Whether the state after `before` still has the arc `token`."""
        state, until = before, _ALWAYS
        while True:
            arc, used_at = token, _ALWAYS
            while True:
                time = self.cut.get((state, arc))
                if time is not None and time < until and time <= used_at:
                    return False
                if arc not in self.starts_with:
                    break
                arc, used_at = self.starts_with[arc]
            if state not in self.state_from:
                return True
            state, since = self.state_from[state]
            until = min(until, since)

    def arc(self, before: int, token: int) -> bool:
        key = (before, token)
        found = self._arcs.get(key)
        if found is None:
            if len(self._arcs) >= KEPT_ARCS:
                self._arcs.clear()
            found = self._arcs[key] = self._exists(before, token)
        return found

    def path(self, word: bytes) -> tuple[int, ...]:
        """The labels of the one path that spells `word`.

        Long tokens are tried first. A prefix is spelt by one path only, so a position that
        led nowhere is not tried again and the work is linear in the word.
        """
        whole = self.tokens.get(word)
        if whole is not None:
            return (whole,)
        tokens, longest, size = self.tokens, self._longest, len(word)
        taken: list[int] = []
        ends: list[int] = []
        dead: set[int] = set()
        at = reach = 0
        while at < size:
            if not reach:
                head = longest.get(word[at:at + 2]) or longest.get(word[at:at + 1], 0)
                reach = min(size, at + head)
            while reach > at:
                token = tokens.get(word[at:reach])
                if (token is not None and reach not in dead
                        and (not taken or self.arc(taken[-1], token))):
                    break
                reach -= 1
            if reach > at:
                taken.append(token)
                ends.append(at)
                at, reach = reach, 0
            elif taken:
                dead.add(at)
                reach = at - 1
                at = ends.pop()
                taken.pop()
            else:
                raise ValueError("a byte of the text is not in the vocabulary")
        return tuple(taken)

    def _word(self, word: str) -> tuple[int, ...]:
        found = self._words.get(word)
        if found is None:
            if len(self._words) >= KEPT_WORDS:
                self._words.clear()
            found = self._words[word] = self.path(word.encode())
        return found

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part, special in self.vocabulary.parts(text):
            if special is None:
                ids.extend(chain.from_iterable(map(self._word, pre_tokens(part))))
            else:
                ids.append(special)
        return ids

    def forget(self) -> None:
        """Empty the tables of looked-up arcs and words; a worker may have other tasks next."""
        self._arcs.clear()
        self._words.clear()

    def decode(self, ids: list[int]) -> str:
        """The arc labels in order; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def compiled(source: str) -> Automaton:
    """The automaton of a vocabulary file's text, once for each worker process."""
    return Automaton(load_vocabulary(source))


def _encoder(source, with_ids: bool) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compiled(source.value)
        digits = {i: str(i) for i in automaton.labels}
        for batch in slices(batches):
            counts, id_digests, text_digests, lists = [], [], [], []
            for text in texts_of(batch):
                ids = automaton.encode(text)
                counts.append(len(ids))
                joined = ",".join(map(digits.__getitem__, ids))
                id_digests.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded = automaton.decode(ids)
                text_digests.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    lists.append(ids)
            columns = {
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(id_digests, pa.string()),
                "decoded_sha256": pa.array(text_digests, pa.string())}
            if with_ids:
                columns["ids"] = pa.array(lists, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)
        automaton.forget()
    return run


def encode(docs: DataFrame, vocabulary: str, with_ids: bool = True) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the text they decode to.

    `docs` has doc_id and text; other columns are not read, whatever their names. One row
    for each input row, repeats included. A null or empty text has no tokens, and so the
    digests of the empty string. An empty table gives an empty result. Special strings inside
    a text become their ids. A very long text is one piece of work; its memory is a small
    multiple of its length. `vocabulary` is the path of a byte-level BPE file on the driver.
    """
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary_file(vocabulary))
    fields = ["doc_id bigint", "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    if with_ids:
        fields.append("ids array<int>")
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(_encoder(source, with_ids), ", ".join(fields))


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and text of rows with `ids`; a null list decodes to the empty text."""
    source = encoded.sparkSession.sparkContext.broadcast(read_vocabulary_file(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compiled(source.value)
        for batch in batches:
            lists = batch.column("ids").to_pylist()
            texts = [automaton.decode(ids or []) for ids in lists]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    rows = encoded.select(encoded["doc_id"].cast("bigint").alias("doc_id"), "ids")
    return rows.mapInArrow(run, "doc_id bigint, text string")
