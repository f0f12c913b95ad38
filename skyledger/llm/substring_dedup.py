"""Repeated passages by relative Lempel-Ziv factors.

Each document is read as a chain of phrases and factored greedily against all that stands
earlier: a smaller doc_id, or the same document further ahead. A phrase is what surrounds an
anchor, a word whose next K words have the least hash among SPAN neighbours; since anchors
depend on the words alone, equal passages have the same ones. Every window of WINDOW words holds
an anchor, and all windows around one lie in its phrase.

The index of the reference is a sorted table of (words at the anchor, whole phrase, place), cut
into blocks by Spark's range partitioning. A phrase that stands earlier too takes the first such
place of its block as its source, and a factor runs on as long as sources continue. What remains are the
boundaries of factors: windows whose anchor has an earlier or later twin, but in another phrase.
Only these are hashed and compared on their own, so no repeated window is missed and none is
reported by chance: phrases are compared by 128 bits, windows by 96.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import discard, identified, materialize, slices, texts_of
from skyledger.llm.hashing import BASE, ODD, mix, word_hashes

WINDOW, K = 20, 6
SPAN = WINDOW - K + 1
# Windows that a task compares on its own before it sends them.
TASK_WINDOWS = 500_000
# Rows of the index that are compared at once.
INDEX_ROWS = 100_000
NO_ID = np.iinfo(np.int64).min
PLACE = ["doc", "text_key", "at"]
_SOURCE = pa.struct([("at", pa.int32()), ("src_doc", pa.int64()), ("src_at", pa.int32())])
_FACTOR = pa.struct([("start", pa.int64()), ("length", pa.int64()),
                     ("source_doc_id", pa.int64()), ("source_start", pa.int64())])
_DIGEST = ("doc bigint, text_key bigint, n_removed bigint, kept_sha256 string, factors array<"
           "struct<start:bigint, length:bigint, source_doc_id:bigint, source_start:bigint>>")


class Words:
    """The words of a text, and hashes of any run of them."""

    def __init__(self, text: str, base: int = BASE) -> None:
        self.hashes = word_hashes(np.frombuffer(text.encode(), np.uint8))[1]
        self.set_base(base)

    def __len__(self) -> int:
        return len(self.hashes)

    def set_base(self, base: int) -> None:
        powers = np.full(len(self) + 1, base, np.uint64)
        inverse = np.full(len(self) + 1, pow(base, -1, 1 << 64), np.uint64)
        powers[0] = inverse[0] = 1
        self._inverse = np.cumprod(inverse, dtype=np.uint64)
        self._sums = np.zeros(len(self) + 1, np.uint64)
        np.cumsum(self.hashes * np.cumprod(powers, dtype=np.uint64)[:-1], out=self._sums[1:])

    def runs(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the words from `first` to before `last`."""
        size = (last - first).astype(np.uint64) * np.uint64(ODD)
        return mix((self._sums[last] - self._sums[first]) * self._inverse[first] + size)


def _slide(values: np.ndarray, size: int, best: Callable) -> np.ndarray:
    """The best of every `size` neighbours."""
    done = 1
    while 2 * done <= size:
        values = best(values[:-done], values[done:])
        done *= 2
    rest = size - done
    return best(values[:-rest], values[rest:]) if rest else values


def _starts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the K words at each place, and the least of them in each window."""
    first = np.arange(len(words) - K + 1)
    hashes = words.runs(first, first + K)
    return hashes, _slide(hashes, SPAN, np.minimum)


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors and the hashes of the K words there; equal least ones all count."""
    if len(words) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes, least = _starts(words)
    around = np.zeros(len(hashes) + SPAN - 1, np.uint64)
    around[SPAN - 1:len(hashes)] = least
    at = np.flatnonzero(_slide(around, SPAN, np.maximum) == hashes)
    return at, hashes[at]


def _phrases(words: Words, at: np.ndarray) -> np.ndarray:
    """Hashes of all words of the windows around each anchor, and of where it stands in them."""
    first = np.maximum(at - (SPAN - 1), 0)
    last = np.minimum(at + WINDOW, len(words))
    return mix(words.runs(first, last) ^ ((at - first).astype(np.uint64) * np.uint64(BASE)))


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        columns: dict[str, list] = {name: [] for name in (
            "n_words", "sha", "key", "phrase", "anchor")}
        for text in texts_of(batch):
            words = Words(text)
            at, keys = anchors(words)
            columns["n_words"].append(len(words))
            columns["sha"].append(digest(text.encode().split()))
            columns["key"].append(keys.view(np.int64))
            columns["phrase"].append(_phrases(words, at).view(np.int64))
            columns["anchor"].append(at.astype(np.int32))
        yield pa.RecordBatch.from_pydict({
            "doc": batch.column("doc"), "text_key": batch.column("text_key"),
            "n_words": pa.array(columns["n_words"], pa.int64()),
            "sha": pa.array(columns["sha"], pa.string()),
            "key": pa.array(columns["key"], pa.list_(pa.int64())),
            "phrase": pa.array(columns["phrase"], pa.list_(pa.int64())),
            "anchor": pa.array(columns["anchor"], pa.list_(pa.int32()))})


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[dict[str, np.ndarray]]:
    """The columns of about `rows` rows at a time."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            table = pa.Table.from_batches(held)
            yield {name: table[name].to_numpy() for name in table.column_names}
            held, size = [], 0
    if size:
        table = pa.Table.from_batches(held)
        yield {name: table[name].to_numpy() for name in table.column_names}


def _changes(values: np.ndarray, before) -> np.ndarray:
    """Whether each value differs from the one before it; `before` stands before the first."""
    found = np.ones(len(values), bool)
    found[1:] = values[1:] != values[:-1]
    if before is not None and len(values):
        found[0] = values[0] != before
    return found


def _sources(doc, text_key, at, src_doc, src_at) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "doc": pa.array(doc), "text_key": pa.array(text_key), "at": pa.array(at, pa.int32()),
        "src_doc": pa.array(src_doc), "src_at": pa.array(src_at, pa.int32())})


def _twins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted block of the index that have a twin: another place with the same key.

    A phrase behind an equal one gets the first of these as its source. The first one has no
    source (src_at -1) and is left out if its key has this phrase alone: then no window in it
    can stand earlier. The first and last keys of a block may go on in another one, so
    their first phrases are never left out.
    """
    before = None  # the row before, as key, phrase, doc, text_key, at
    source, waiting = None, None  # first place of this phrase; of this key, while it has one phrase
    for rows in _chunks(batches, INDEX_ROWS):
        names = ["key", "phrase", *PLACE]
        moved = np.zeros(len(rows["key"]), bool)
        for i, name in enumerate(names):
            moved |= _changes(rows[name], None if before is None else before[i])
        key, phrase, doc, text_key, at = (rows[name][moved] for name in names)
        if not len(key):
            continue
        fresh = _changes(key, None if before is None else before[0])
        head = fresh | _changes(phrase, None if before is None else before[1])
        of_key = np.cumsum(fresh) - fresh[0]
        several = np.bincount(of_key[head & ~fresh], minlength=of_key[-1] + 1) > 0
        if before is None:
            several[0] = True
        if waiting is not None and (fresh[0] or several[0]):
            if not fresh[0]:
                yield _sources(*([part] for part in waiting), [waiting[0]], [-1])
            waiting = None
        last = np.flatnonzero(fresh)[-1:]
        if len(last) and not several[-1]:
            waiting = doc[last[0]], text_key[last[0]], at[last[0]]
        elif len(last):
            waiting = None
        first = np.maximum.accumulate(np.where(head, np.arange(len(key)), -1))
        src_doc, src_at = doc[first], at[first]
        if source is not None:
            src_doc[first < 0], src_at[first < 0] = source
        source = src_doc[-1], src_at[-1]
        src_at = np.where(head, -1, src_at)
        told = ~head | several[of_key]
        yield _sources(doc[told], text_key[told], at[told], src_doc[told], src_at[told])
        before = key[-1], phrase[-1], doc[-1], text_key[-1], at[-1]
    if waiting is not None:
        yield _sources(*([part] for part in waiting), [waiting[0]], [-1])


def _listed(column: pa.Array) -> list[dict[str, np.ndarray]]:
    """The structs in each list of a column, as one array for each field; null is an empty list."""
    ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy())
    flat = column.flatten()
    fields = {name: flat.field(name).to_numpy() for name in ("at", "src_doc", "src_at")}
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return [{name: values[a:b] for name, values in fields.items()}
            for a, b in zip(starts, ends, strict=True)]


class _Known:
    """What the index tells about the windows of one text."""

    def __init__(self, words: Words, told: dict[str, np.ndarray]) -> None:
        count = len(words) - WINDOW + 1
        rows = np.flatnonzero(told["src_at"] >= 0)
        rows = rows[np.argsort(told["at"][rows], kind="stable")]
        self._at = told["at"][rows].astype(np.int64)
        self._doc = told["src_doc"][rows]
        self._from = told["src_at"][rows].astype(np.int64)
        self.repeated = self._around(self._at, count) > 0
        # An equal window has the same least hash, so the anchor that has it needs a twin.
        hashes, least = _starts(words)
        others = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
        others[told["at"]] = hashes[told["at"]]
        self.open = (_slide(others, SPAN, np.minimum) == least) & ~self.repeated

    @staticmethod
    def _around(at: np.ndarray, count: int) -> np.ndarray:
        """How many of the anchors `at` each of `count` windows holds."""
        marks = np.zeros(count + SPAN, np.int64)
        marks[1:] = np.bincount(at, minlength=count + SPAN - 1)[:count + SPAN - 1]
        sums = np.cumsum(marks)
        return sums[SPAN:] - sums[:-SPAN]

    def sources(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The repeated windows and where each stands earlier."""
        starts = np.flatnonzero(self.repeated)
        row = np.searchsorted(self._at, starts)
        return starts, self._doc[row], self._from[row] - (self._at[row] - starts)


def _later(h1, h2, doc, text_key, at):
    """Order of the rows by window and place, and of each in it the first place of its window."""
    order = np.lexsort((at, text_key, doc, h2, h1))
    h1, h2 = h1[order], h2[order]
    head = _changes(h1, None) | _changes(h2, None)
    first = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    later = (doc[order] != doc[first]) | (text_key[order] != text_key[first]) | (
        at[order] != at[first])
    return order, first, head, later


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The open windows of each text; those that stand earlier in this task have a source."""
    parts: list[tuple] = []
    held = 0

    def flush() -> pa.RecordBatch:
        h1, h2, doc, text_key, at = (np.concatenate([p[i] for p in parts]) for i in range(5))
        order, first, head, later = _later(h1, h2, doc, text_key, at)
        rows = np.flatnonzero(head | later)  # equal places of repeated rows once
        own = order[rows]
        return pa.RecordBatch.from_pydict({
            "h1": pa.array(h1[own].view(np.int64)), "h2": pa.array(h2[own].view(np.int32)),
            "doc": pa.array(doc[own]), "text_key": pa.array(text_key[own]),
            "at": pa.array(at[own], pa.int32()), "src_doc": pa.array(doc[first[rows]]),
            "src_at": pa.array(np.where(later[rows], at[first[rows]], -1), pa.int32())})

    for batch in slices(batches):
        names = zip(batch.column("doc").to_pylist(), batch.column("text_key").to_pylist(),
                    strict=True)
        told = _listed(batch.column("told"))
        for (doc, text_key), text, rows in zip(names, texts_of(batch), told, strict=True):
            words = Words(text)
            at = np.flatnonzero(_Known(words, rows).open)
            h1 = words.runs(at, at + WINDOW)
            words.set_base(ODD)
            h2 = (words.runs(at, at + WINDOW) >> np.uint64(32)).astype(np.uint32)
            parts.append((h1, h2, np.full(len(at), doc), np.full(len(at), text_key), at))
            held += len(at)
            if held >= TASK_WINDOWS:
                yield flush()
                parts, held = [], 0
    if held:
        yield flush()


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of windows in order, those that stand at an earlier place too, with the first one."""
    before, source = None, None
    for rows in _chunks(batches, INDEX_ROWS):
        h1, h2, doc, text_key, at = (rows[name] for name in ("h1", "h2", *PLACE))
        head = _changes(h1, None if before is None else before[0]) | _changes(
            h2, None if before is None else before[1])
        first = np.maximum.accumulate(np.where(head, np.arange(len(h1)), -1))
        src = [part[first] for part in (doc, text_key, at)]
        if source is not None:
            for part, known in zip(src, source, strict=True):
                part[first < 0] = known
        later = (doc != src[0]) | (text_key != src[1]) | (at != src[2])
        yield _sources(doc[later], text_key[later], at[later], src[0][later], src[2][later])
        before, source = (h1[-1], h2[-1]), [part[-1] for part in src]


def _factors(starts, docs, first) -> list[dict]:
    """Greedy factors over repeated windows: each goes on as long as its source does."""
    if not len(starts):
        return []
    breaks = np.ones(len(starts), bool)
    breaks[1:] = (np.diff(starts) != 1) | (docs[1:] != docs[:-1]) | (np.diff(first) != 1)
    heads = np.flatnonzero(breaks)
    tails = np.append(heads[1:], len(starts)) - 1
    return [{"start": int(starts[a]), "length": int(starts[b] - starts[a]) + WINDOW,
             "source_doc_id": None if docs[a] == NO_ID else int(docs[a]),
             "source_start": int(first[a])} for a, b in zip(heads, tails, strict=True)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        removed, shas, factors = [], [], []
        told, found = _listed(batch.column("told")), _listed(batch.column("found"))
        for text, known, more in zip(texts_of(batch), told, found, strict=True):
            starts, docs, first = _Known(Words(text), known).sources()
            if len(more["at"]):
                starts, rows = np.unique(
                    np.concatenate([starts, more["at"].astype(np.int64)]), return_index=True)
                docs = np.concatenate([docs, more["src_doc"]])[rows]
                first = np.concatenate([first, more["src_at"].astype(np.int64)])[rows]
            words = text.encode().split()
            edges = np.bincount(starts, minlength=len(words) + 1)
            edges = edges - np.bincount(starts + WINDOW, minlength=len(words) + 1)
            gone = np.cumsum(edges)[:-1] > 0
            removed.append(int(gone.sum()))
            shas.append(digest(list(compress(words, (~gone).tolist()))))
            factors.append(_factors(starts, docs, first))
        yield pa.RecordBatch.from_pydict({
            "doc": batch.column("doc"), "text_key": batch.column("text_key"),
            "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(shas, pa.string()),
            "factors": pa.array(factors, pa.list_(_FACTOR))})


def _by_text(rows: DataFrame, name: str) -> DataFrame:
    """One row for each text; written, so that a join deals its rows out anew."""
    row = F.struct("at", "src_doc", "src_at")
    return materialize(
        rows.groupBy("doc", "text_key").agg(F.collect_list(row).alias(name)), name)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, n_removed, kept_sha256 and factors of every row of `docs`.

    Words are cut at ASCII white space and compared unchanged. A window is WINDOW words in a row of one
    document; if its words also start earlier (smaller doc_id, or same document and earlier
    start), all of them are removed. Windows are judged on the input. kept_sha256 is that of the other
    words, joined by a space. A factor is a stretch of the document, of WINDOW words or more,
    with the place of the same words that stand earlier; factors may overlap.

    `docs` has doc_id and text; other columns are not read. A null or empty text has no words, and
    one of fewer than WINDOW words loses none. A null doc_id counts as the smallest. Rows
    that agree in doc_id and text are one document, and each gets its result; different texts
    of one doc_id stand in the order of a hash. Very long texts are handled whole, one at a time.
    An empty table gives an empty result.
    """
    texts = identified(docs.select(
        F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NO_ID)).alias("doc_id"), docs["text"])
    ).withColumnRenamed("doc_id", "doc")
    parsed = materialize(texts.select("doc", "text_key", "text").mapInArrow(
        _parsed, "doc bigint, text_key bigint, n_words bigint, sha string, key array<bigint>, "
        "phrase array<bigint>, anchor array<int>"), "parsed")
    index = parsed.select("doc", "text_key", F.inline(F.arrays_zip(
        "key", "phrase", F.col("anchor").alias("at"))))
    order = ["key", "phrase", *PLACE]
    sources = "doc bigint, text_key bigint, at int, src_doc bigint, src_at int"
    told = _by_text(index.repartitionByRange(*order).sortWithinPartitions(*order)
                    .mapInArrow(_twins, sources), "told")
    rows = materialize(parsed.select("doc", "text_key", "n_words", "sha"), "rows")
    discard(parsed)
    repeating = materialize(texts.join(told, ["doc", "text_key"]), "repeating")
    discard(told)
    windows = materialize(
        repeating.select("doc", "text_key", "text", "told").mapInArrow(
            _windows, f"h1 bigint, h2 int, {sources}"), "windows")
    order = ["h1", "h2", *PLACE]
    compared = (windows.where("src_at < 0").select(*order).repartition("h1")
                .sortWithinPartitions(*order).mapInArrow(_compared, sources))
    found = _by_text(compared.unionAll(
        windows.where("src_at >= 0").select(*PLACE, "src_doc", "src_at")), "found")
    discard(windows)
    cut = repeating.join(found, ["doc", "text_key"], "left").select(
        "doc", "text_key", "text", "told", "found").mapInArrow(_cut, _DIGEST)
    cut = materialize(cut.dropDuplicates(["doc", "text_key"]), "cut")
    discard(repeating)
    return rows.join(cut, ["doc", "text_key"], "left").select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "text_key", "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        F.coalesce("factors", F.array().cast(cut.schema["factors"].dataType)).alias("factors"))


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda w: w <> '') AS w
  FROM documents),
windows AS (
  SELECT doc_id, n, array_to_string(w[n:n + 19], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS n FROM words)),
firsts AS (SELECT words, min((doc_id, n)) AS place FROM windows GROUP BY words),
later AS (
  SELECT doc_id, n FROM windows JOIN firsts USING (words) WHERE (doc_id, n) > place),
gone AS (
  SELECT doc_id, list(DISTINCT n) AS gone
  FROM (SELECT doc_id, unnest(range(n, n + 20)) AS n FROM later) GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(w) AS n_words,
         list_filter(w, lambda word, i: NOT list_contains(coalesce(gone, []), i)) AS left_over
  FROM words LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, n_words - len(left_over) AS n_removed,
       sha256(array_to_string(left_over, ' ')) AS kept_sha256
FROM kept
"""
