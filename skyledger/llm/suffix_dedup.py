"""Repeated passages by a sparse suffix array.

Only suffixes that start at a minimiser are kept: the word whose next K words have the least
hash among SPAN neighbours. A passage of LENGTH words holds SPAN such neighbours at its start,
so wherever it stands the same suffix of it is kept, with at least REACH of its words behind
it. Suffixes are sorted by the hash of those words, and only one that equals a neighbour in
that order goes on. It is then extended: to the left over the places at which a passage around
it may start, to the right to the full length. Extended windows that occur at another place
too, in the same or another document, are repeats, and neighbouring ones that were first seen
in the same document form one span. No passage of LENGTH words is missed and no shorter one
reported.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import free_name, identified, materialize, slices, texts_of
from skyledger.llm.hashing import BASE, ODD, Shards, mapped, mix, word_hashes, write_table
from skyledger.session import fresh_folder

LENGTH, K, SPAN = 50, 8, 25
REACH = LENGTH - SPAN + 1
# Windows that a task gathers before it sends its blocks, and windows for each shard.
TASK_WINDOWS, SHARD_WINDOWS = 200_000, 1_000_000
# Bytes of text whose windows a task holds at once: each word may start one, of 28 bytes and as much to sort.
WINDOWED_BYTES = 1 << 20
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]*")
NO_ID = np.iinfo(np.int64).min
PLACE = np.dtype([("doc", "<i8"), ("text", "<i8"), ("at", "<i4")])
_SPANS = ("start bigint, length bigint, first_doc_id bigint, first_start bigint, "
          "is_first boolean")


def word_keys(text: str) -> np.ndarray:
    """Hashes of the words of a text, cut at ASCII white space after A-Z are lower-cased."""
    data = np.frombuffer(text.encode(), np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    return word_hashes(data)[1]


class Runs:
    """Hashes of any run of a text's words, from running sums of one polynomial."""

    def __init__(self, words: np.ndarray) -> None:
        self._powers = np.full(len(words) + 1, BASE, np.uint64)
        self._inverse = np.full(len(words) + 1, pow(BASE, -1, 1 << 64), np.uint64)
        for powers in (self._powers, self._inverse):
            powers[0] = 1
            np.cumprod(powers, out=powers)
        self._sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * self._powers[:-1], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, size: int) -> np.ndarray:
        sums = self._sums[starts + size] - self._sums[starts]
        return mix(sums * self._inverse[starts] + np.uint64(size * ODD % (1 << 64)))


def kept_suffixes(words: np.ndarray, runs: Runs) -> np.ndarray:
    """Starts of the suffixes at minimisers that have REACH words; the leftmost if equal."""
    count = len(words) - K + 1
    if len(words) < LENGTH:
        return np.zeros(0, np.int64)
    hashes = runs.hashes(np.arange(count), K)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, SPAN)
    found = np.empty(len(windows), np.int64)
    for first in range(0, len(windows), 1 << 18):  # argmin copies its windows
        part = windows[first:first + (1 << 18)]
        found[first:first + len(part)] = part.argmin(axis=1) + np.arange(
            first, first + len(part))
    found = found[np.diff(found, prepend=-1) != 0]
    return found[found + REACH <= len(words)]


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        keys, texts, places = [], [], []
        for text, name in zip(texts_of(batch), batch.column("text_key").to_pylist(), strict=True):
            words = word_keys(text)
            if len(words) < LENGTH:
                continue
            runs = Runs(words)
            at = kept_suffixes(words, runs)
            keys.append(runs.hashes(at, REACH))
            texts.append(np.full(len(at), name, np.int64))
            places.append(at)
        empty = [np.zeros(0, np.int64)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys or empty).astype(np.uint64).view(np.int64)),
             pa.array(np.concatenate(texts or empty)),
             pa.array(np.concatenate(places or empty).astype(np.int32))],
            names=["key", "text_key", "at"])


def _beside_an_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose key equals that of the row before or behind.

    Rows with the first key of the task and its last row pass as well: their neighbour may lie
    in another task, and the extension will tell. So equal keys may be split over tasks.
    """
    waiting, first, before = None, None, None

    def part(batch: pa.RecordBatch, last: bool) -> pa.RecordBatch:
        nonlocal before
        keys = batch.column("key").to_numpy()
        usable = len(keys) if last else len(keys) - 1
        same = np.zeros(len(keys), bool)
        equal = keys[1:] == keys[:-1]
        same[1:] |= equal
        same[:-1] |= equal
        same |= keys == first
        if before is not None:
            same[0] |= keys[0] == before
        same[-1] |= last
        if usable:
            before = keys[usable - 1]
        return batch.slice(0, usable).filter(pa.array(same[:usable]))

    for batch in batches:
        if not batch.num_rows:
            continue
        if first is None:
            first = batch.column("key")[0].as_py()
        if waiting is not None:
            joined = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
        else:
            joined = batch
        yield part(joined, False).select(["text_key", "at"])
        waiting = joined.slice(joined.num_rows - 1)
    if waiting is not None:
        yield part(waiting, True).select(["text_key", "at"])


def _candidates(texts: DataFrame) -> DataFrame:
    """doc_id, text_key, text and the repeated suffixes of each document that has any."""
    rows = texts.select("text_key", "text").mapInArrow(
        _suffixes, "key bigint, text_key bigint, at int")
    suffixes = materialize(rows, "suffixes")
    order = ["key", "text_key", "at"]
    ranked = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    found = ranked.mapInArrow(_beside_an_equal, "text_key bigint, at int")
    # written, so that the join deals its rows out anew and can split the copies of one text
    by_text = materialize(
        found.groupBy("text_key").agg(F.collect_set("at").alias("suffixes")), "suffixes-of-texts")
    return materialize(texts.join(by_text, "text_key"), "repeating")


def _window_starts(words: np.ndarray, suffixes: list[int]) -> np.ndarray:
    """Every start of a window around a suffix."""
    at = np.array(sorted(suffixes), np.int64)
    starts = (at[:, None] - np.arange(SPAN)).ravel()
    return np.unique(starts[(starts >= 0) & (starts <= len(words) - LENGTH)])


def _windows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each row the places of its windows, their hashes, and its word count."""
    ids = [NO_ID if doc is None else doc for doc in batch.column("doc_id").to_pylist()]
    for doc, name, text, suffixes in zip(
            ids, batch.column("text_key").to_pylist(), texts_of(batch),
            batch.column("suffixes").to_pylist(), strict=True):
        words = word_keys(text)
        starts = _window_starts(words, suffixes)
        places = np.empty(len(starts), PLACE)
        places["doc"], places["text"], places["at"] = doc, name, starts
        yield places, Runs(words).hashes(starts, LENGTH), len(words)


def _first_places(keys, places, repeated):
    """Distinct keys, the first place of each, and whether it has another place as well."""
    order = np.lexsort((places["at"], places["text"], places["doc"], keys))
    keys, places, repeated = keys[order], places[order], repeated[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(fresh)
    if not len(at):
        return keys, places, repeated
    # equal keys stand in order of place: any other place differs from the first
    other = places != places[at][np.cumsum(fresh) - 1]
    return keys[at], places[at], np.logical_or.reduceat(repeated | other, at)


def _home(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys + np.uint64(BASE)) % np.uint64(shards)).astype(np.int64)


def _blocks(shards: int):
    """(shard, block) rows: the distinct windows of a task with their first places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def flush() -> pa.RecordBatch:
            keys, places = (np.concatenate([p[i] for p in parts]) for i in range(2))
            keys, places, again = _first_places(keys, places, np.zeros(len(keys), bool))
            home = _home(keys, shards)
            order = np.argsort(home, kind="stable")
            at = np.flatnonzero(np.diff(home[order], prepend=-1))
            names = home[order[at]]
            blobs = [b"".join([
                np.array([len(rows)], "<u8").tobytes(), keys[rows].tobytes(),
                places[rows].tobytes(), np.packbits(again[rows]).tobytes()])
                for rows in (np.split(order, at[1:]) if len(at) else [])]
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), pa.array(blobs, pa.binary())],
                names=["shard", "block"])

        for batch in slices(batches, most=WINDOWED_BYTES):
            for places, hashes, _ in _windows(batch):
                parts.append((hashes, places))
                held += len(places)
                if held >= TASK_WINDOWS:
                    yield flush()
                    parts, held = [], 0
        if parts:
            yield flush()
    return run


def _unpacked(blob: bytes):
    count = int(np.frombuffer(blob, "<u8", 1)[0])
    keys = np.frombuffer(blob, "<u8", count, 8)
    places = np.frombuffer(blob, PLACE, count, 8 + 8 * count)
    end = 8 + (8 + PLACE.itemsize) * count
    again = np.unpackbits(np.frombuffer(blob, np.uint8, -1, end), count=count)
    return keys, places, again.astype(bool)


def _merge(folder: str):
    """Write each shard's repeated windows and their first places, sorted by window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []

        def finish() -> pa.RecordBatch:
            keys, places, again = _first_places(
                *(np.concatenate([p[i] for p in parts]) for i in range(3)))
            write_table(folder, f"windows-{shard}", keys[again], places[again])
            return pa.RecordBatch.from_pydict({"repeated": pa.array([again.sum()], pa.int64())})

        for batch in batches:
            for name, blob in zip(batch.column("shard").to_pylist(), batch.column("block"),
                                  strict=True):
                if name != shard and parts:
                    yield finish()
                    parts = []
                shard = name
                parts.append(_unpacked(blob.as_buffer().to_pybytes()))
        if parts:
            yield finish()
    return run


@dataclass(frozen=True)
class Table:
    """Where the repeated windows are."""

    folder: str
    shards: int


class _Lookup:
    def __init__(self, table: Table) -> None:
        self._table = table
        self._shards = Shards(self._read)

    def _read(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        return (mapped(self._table.folder, f"windows-{shard}.keys", np.dtype("<u8")),
                mapped(self._table.folder, f"windows-{shard}.rows", PLACE))

    def first_places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each window is repeated, and its first place."""
        found, places = np.zeros(len(keys), bool), np.zeros(len(keys), PLACE)
        homes = _home(keys, self._table.shards)
        order = np.lexsort((keys, homes))
        heads = np.flatnonzero(np.diff(homes[order], prepend=-1))
        for rows in np.split(order, heads[1:]) if len(heads) else []:
            shard = int(homes[rows[0]])
            known, values = self._shards[shard]
            if len(known):
                at = np.minimum(np.searchsorted(known, keys[rows]), len(known) - 1)
                hit = known[at] == keys[rows]
                found[rows[hit]] = True
                places[rows[hit]] = values[at[hit]]
        return found, places


def _spans(own_places: np.ndarray, found: np.ndarray, places: np.ndarray) -> list[tuple]:
    """Runs of repeated windows, each one word behind the last, first seen in one document."""
    rows = np.flatnonzero(found)
    if not len(rows):
        return []
    own = own_places[rows] == places[rows]
    at = own_places["at"][rows].astype(np.int64)
    docs, texts = places["doc"][rows], places["text"][rows]
    first = places["at"][rows].astype(np.int64)
    breaks = np.ones(len(rows), bool)
    breaks[1:] = (np.diff(at) != 1) | (docs[1:] != docs[:-1]) | (
        texts[1:] != texts[:-1]) | (own[1:] != own[:-1])
    heads = np.flatnonzero(breaks)
    tails = np.append(heads[1:], len(rows)) - 1
    return [(int(at[a]), int(at[b] - at[a]) + LENGTH,
             None if docs[a] == NO_ID else int(docs[a]), int(first[a]), bool(own[a]))
            for a, b in zip(heads, tails, strict=True)]


def _finder(table: Table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(table)
        span = pa.struct([("start", pa.int64()), ("length", pa.int64()),
                          ("first_doc_id", pa.int64()), ("first_start", pa.int64()),
                          ("is_first", pa.bool_())])
        names = [field.name for field in span]
        for batch in slices(batches, most=WINDOWED_BYTES):
            rows = list(_windows(batch))
            found, places = lookup.first_places(np.concatenate([r[1] for r in rows]))
            ends = np.cumsum([len(r[0]) for r in rows])
            spans = [[dict(zip(names, s, strict=True)) for s in _spans(
                own, found[end - len(own):end], places[end - len(own):end])]
                for (own, _, _), end in zip(rows, ends, strict=True)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"),
                "n_words": pa.array([r[2] for r in rows], pa.int64()),
                "spans": pa.array(spans, pa.list_(span))})
    return run


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words and spans of each document with a repeated passage.

    A span is a stretch of words of which each LENGTH in a row stand, word for word, at another
    place too. is_first: here is the earliest place of each of them; else first_doc_id has it,
    that of the span's first words at first_start. Places are ordered by doc_id, hash of the text
    and word; start counts words from 0, length is in words.

    `docs` has doc_id and text; other columns are not read, whatever their names. One row for
    each input row with a span: documents without one do not appear. A null or empty text, or one
    of fewer words, has no span. Rows that agree in doc_id and text are the same places, so repeated
    rows do not repeat each other; different texts of one doc_id do. Null ids count as one smallest
    id. Very long texts are handled whole, one at a time. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = identified(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]))
    candidates = _candidates(texts)
    count = candidates.agg(F.sum(F.size("suffixes").cast("bigint"))).first()[0] or 0
    shards = max(8, math.ceil(count * SPAN / 2 / SHARD_WINDOWS))
    folder = fresh_folder(spark, "windows")
    fields = candidates.select("doc_id", "text_key", "text", "suffixes")
    blocks = fields.mapInArrow(_blocks(shards), "shard int, block binary")
    merged = (blocks.repartition(shards, "shard").sortWithinPartitions("shard")
              .mapInArrow(_merge(folder), "repeated bigint"))
    merged.agg(F.sum("repeated")).first()
    found = fields.mapInArrow(
        _finder(Table(folder, shards)),
        f"doc_id bigint, text_key bigint, n_words bigint, spans array<struct<{_SPANS}>>")
    return found.where(F.size("spans") > 0)


def passages(docs: DataFrame) -> DataFrame:
    """One row for each span: doc_id, start, length, first_doc_id, first_start, is_first."""
    return repeated_spans(docs).select("doc_id", F.inline("spans"))


def cut_text(text: str, spans: list) -> str:
    """The text without the words of the spans and the white space behind each span."""
    words = list(WORD.finditer(text))
    cut = np.zeros(len(words) + 1, bool)
    for start, length in spans:
        cut[start:start + length] = True
    edges = np.flatnonzero(np.diff(cut.astype(np.int8), prepend=0))
    kept, at = [], 0
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        kept.append(text[at:words[a].start()])
        at = SPACE.match(text, words[b - 1].end()).end()
    return "".join([*kept, text[at:]])


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The rows, with all their columns, without passages that stand at an earlier place.

    Only the earliest place of a passage keeps it. A document that loses all its words goes;
    all others stay, and those without a cut are unchanged. n_chars, if there is such a
    column, is the length of the new text.
    """
    cut_id, cut_key, cuts_of, fresh_text = (
        free_name(docs, name) for name in ("cut_id", "cut_key", "cuts", "fresh"))
    cuts = repeated_spans(docs).select(
        F.col("doc_id").alias(cut_id), F.col("text_key").alias(cut_key),
        F.filter("spans", lambda span: ~span["is_first"]).alias(cuts_of))
    cuts = cuts.where(F.size(cuts_of) > 0).dropDuplicates([cut_id, cut_key])

    @F.pandas_udf("string")
    def without(texts, spans):
        return texts.combine(spans, lambda text, found: None if found is None else cut_text(
            text, [(span["start"], span["length"]) for span in found]))

    # a deterministic function would be put into the filter below as well, and so run twice for each
    # text, in a second worker beside the first
    without = without.asNondeterministic()
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    joined = docs.join(cuts, docs["doc_id"].cast("bigint").eqNullSafe(cuts[cut_id]) & (
        key == cuts[cut_key]), "left")
    joined = joined.withColumn(fresh_text, F.when(
        F.col(cuts_of).isNotNull(), without(docs["text"], F.col(cuts_of))))
    fresh = F.col(fresh_text)
    kept = joined.where(fresh.isNull() | fresh.rlike(r"[^\x20\x09-\x0D]"))
    changed = {"text": F.coalesce(fresh, docs["text"])}
    if "n_chars" in docs.columns:
        length = F.length(fresh).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.coalesce(length, docs["n_chars"])
    return kept.select(*(changed[c].alias(c) if c in changed else docs[c] for c in docs.columns))
