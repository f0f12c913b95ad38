"""Near-duplicates by SimHash fingerprints that differ in at most two bits.

Pairs to compare come from blocks: 64 bits are cut in four, and two fingerprints that differ
in two bits agree in two whole blocks at least, so each fingerprint enters six tables under
32 of its bits. Fingerprints that share an entry are compared bit-sliced: plane b holds bit b
of all of them, 64 to a word, and carry-save counters add up the differences of one
fingerprint to all others, plane by plane, until all of them exceed the radius.

Only different fingerprints are compared, so copies of a text cost nothing. An entry with more
fingerprints than one comparison should hold is not compared but expanded: two fingerprints
within two bits share one of the 65 values within one bit of each. No value has more than 65
owners, so that way has no large groups, and it is as exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import identified, materialize, slices, texts_of
from skyledger.llm.components import components

SHINGLE, SEED, RADIUS = 3, 42, 2
BLOCKS, WIDTH = 4, 16
# Fingerprints of one table entry that are compared in one piece; more are expanded.
LARGEST_ENTRY = 4096
# Entries are packed until a comparison has this many fingerprints.
PACKED = 256
# Shingles whose bits are unpacked at once.
UNPACKED = 1 << 16


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, the lowest first."""
    counts = np.zeros(64, np.int64)
    for first in range(0, len(hashes), UNPACKED):
        part = hashes[first:first + UNPACKED].astype("<u8", copy=False)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return counts


def majority(counts: np.ndarray, total: int) -> int:
    """The fingerprint with the bits that over half of `total` hashes have."""
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's shingles, repeats included; 0 without a word."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = [len(word) + 1 for word in words]
    ends = list(accumulate(lengths))
    starts = [0, *ends[:-1]]
    reach = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    counts, total = np.zeros(64, np.int64), len(words) - reach
    for first in range(0, total, UNPACKED):
        last = min(total, first + UNPACKED)
        hashes = np.array([digest(joined[a:b - 1], SEED) for a, b in zip(
            starts[first:last], ends[first + reach:last + reach], strict=True)], "<u8")
        counts += set_bits(hashes)
    return majority(counts, total)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key and fp (as a signed number) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(text, shingle) for text in texts_of(batch)], np.uint64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"),
                "fp": pa.array(found.view(np.int64))})

    rows = identified(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]))
    return rows.mapInArrow(run, "doc_id bigint, text_key bigint, fp bigint")


def _adjacent(fps: np.ndarray) -> np.ndarray:
    """For each of n fingerprints the lanes within the radius, as bits of n / 64 words."""
    count = len(fps)
    padded = np.zeros(-(-count // 64) * 64, "<u8")
    padded[:count] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
    ones = np.zeros((count, planes.shape[1]), "<u8")
    twos, over = ones.copy(), ones.copy()
    queries = np.arange(count)
    flip = np.negative(bits[:count].astype(np.uint64)).T  # all bits of a word, or none, by plane
    every = np.uint64(0xFFFFFFFFFFFFFFFF)
    result = np.zeros_like(ones)
    for plane in range(64):
        differs = planes[plane] ^ flip[plane][queries, None]
        carry = ones & differs
        ones ^= differs
        over |= twos & carry
        twos ^= carry
        if plane % 8 == 7:  # leave out the fingerprints that exceed the radius to all but themselves
            far = over | (ones & twos)
            open_lanes = np.bitwise_count(~far & every).sum(axis=1)
            alive = open_lanes > 1
            if not alive.all():
                queries, ones, twos, over = queries[alive], ones[alive], twos[alive], over[alive]
                if not len(queries):
                    return result
    result[queries] = ~(over | (ones & twos)) & every
    spare = len(padded) - count
    if spare:
        result[:, -1] &= np.uint64((1 << (64 - spare)) - 1)
    return result


def _stars(fps: np.ndarray) -> list[tuple[int, int]]:
    """An edge from the first fingerprint of each linked group to each other one."""
    rows = _adjacent(fps)
    linked = np.flatnonzero(np.bitwise_count(rows).sum(axis=1) > 1)
    seen = np.zeros(len(fps), bool)
    edges = []
    for seed in linked:
        if seen[seed]:
            continue
        seen[seed] = True
        front = [seed]
        while front:
            reached = np.bitwise_or.reduce(rows[front], axis=0)
            lanes = np.unpackbits(reached.view(np.uint8), bitorder="little")[:len(fps)]
            front = np.flatnonzero(lanes.astype(bool) & ~seen)
            seen[front] = True
            edges += [(int(fps[seed]), int(fps[other])) for other in front]
            front = front.tolist()
    return edges


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def block(lists: list[list[int]]) -> pa.RecordBatch:
        fps = np.unique(np.array([fp for found in lists for fp in found], np.int64))
        edges = np.array(_stars(fps.view(np.uint64)), np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"])

    waiting, held = [], 0
    for batch in batches:
        for found in batch.column("fps").to_pylist():
            waiting.append(found)
            held += len(found)
            if held >= PACKED:
                yield block(waiting)
                waiting, held = [], 0
    if waiting:
        yield block(waiting)


def links(fps: DataFrame, largest: int = LARGEST_ENTRY) -> DataFrame:
    """Edges (a, b) that connect all different fingerprints within the radius.

    `fps` has one row for each different fp. An edge may stand for a path of links. The
    entries of a table are counted before any is gathered; what is gathered is at most
    `largest` fingerprints.
    """
    def part(block: int):
        return F.shiftrightunsigned("fp", block * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1))

    entries = [F.struct(F.lit(table).alias("table"),
                        (F.shiftleft(part(a), WIDTH) + part(b)).alias("entry"))
               for table, (a, b) in enumerate(combinations(range(BLOCKS), BLOCKS - RADIUS))]
    keyed = fps.select("fp", F.explode(F.array(*entries)).alias("k")).select("fp", "k.*")
    keys = ["table", "entry"]
    shared = materialize(
        keyed.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1), "entries")
    small = keyed.join(shared.where(F.col("n") <= largest).select(*keys), keys)
    lists = small.groupBy(*keys).agg(F.collect_list("fp").alias("fps")).select("fps")
    near = lists.mapInArrow(_compared, "a bigint, b bigint")
    crowded = keyed.join(shared.where(F.col("n") > largest).select(*keys), keys)
    return near.unionAll(_expanded(crowded.select("fp").distinct()))


def _expanded(fps: DataFrame) -> DataFrame:
    """Edges between fingerprints that share a value within one bit of each."""
    values = F.array(F.col("fp"), *(
        F.col("fp").bitwiseXOR(F.shiftleft(F.lit(1).cast("bigint"), bit)) for bit in range(64)))
    owned = fps.select("fp", F.explode(values).alias("value"))
    least = owned.groupBy("value").agg(F.min("fp").alias("b"), F.count("*").alias("n"))
    shared = least.where(F.col("n") > 1).drop("n")
    return (owned.join(shared, "value").where(F.col("fp") != F.col("b"))
            .select(F.col("fp").alias("a"), "b").distinct())


def classes(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key, fp and root of every row; rows of one class have the same root."""
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    edges = links(rows.select("fp").distinct())
    roots = materialize(components(edges).select(F.col("node").alias("fp"), "root"), "roots")
    return rows.join(roots, "fp", "left").select(
        "doc_id", "text_key", "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint and component_id of every text.

    `docs` has doc_id and text; other columns are not read, whatever their names. One row for
    each input row, repeats included. Words are cut at ASCII white space after A-Z are lower-
    cased. A null or empty text has fingerprint zero and links like any other. component_id is
    the smallest doc_id of the class, null if it has none. A very long text is fingerprinted whole, in
    memory in proportion to its length. An empty table gives an empty result.
    """
    rows = classes(docs, shingle)
    # written, so that the join deals its rows out anew and can split those of a large class
    least = materialize(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "classes")
    return rows.join(least, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_classes(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The row of the smallest doc_id for each root of `rows`, with all columns of `docs`."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = rows.groupBy("root").agg(F.min(first).alias("k")).select(
        F.col("k.doc_id").alias("kept_id_"), F.col("k.text_key").alias("kept_key_"))
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    found = docs.join(kept, docs["doc_id"].cast("bigint").eqNullSafe(kept["kept_id_"]) & (
        key == kept["kept_key_"]))
    return found.dropDuplicates(["kept_id_", "kept_key_"]).select(docs["*"])


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each class, with all its columns: that of the smallest doc_id.

    A class without any doc_id keeps the text of smallest hash; of repeated rows one stays.
    """
    return first_of_classes(docs, classes(docs, shingle))
