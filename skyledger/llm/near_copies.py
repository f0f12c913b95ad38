"""Near copies: texts that share at least 0.8 of their five-word shingles.

Texts whose SimHash fingerprints link (see `simhash`: six tables, bit-sliced comparison, two bits
at most) are paired first and their sets checked. Pairs of similarity 0.8 may differ in more bits
than any radius allows, so those that are not in one class yet are then found by their shingles.

These pairs are exact. In any one order of all shingles, two sets of similarity 0.8 share one of
their first n / 5 + 1, so texts meet under those. Shingles that are frequent in a sample come
last in the order, which keeps groups small and may be any set. Texts with equal sets are
one. Pairs of a group whose sizes differ too much, or whose parity bitmaps differ in more bits
than two such sets have different shingles, are left out. Of the others, those whose finer bitmaps
differ in so few bits that the sets must be similar are taken, and the sets of the few between
are compared. A group is first covered by stars, so many near copies of one text cost one
comparison each; only groups that the confirmed stars leave in different classes follow.

Groups are runs of a table of (shingle, text) that is sorted in ranges, and travel as numbers;
no text is joined to a pair unless its bitmaps leave the pair open. A large group is no list: all its
texts are paired with one of them, by a join, and if that leaves several classes, it is split by
a second shingle, since similar sets share two of one more than the first n / 5 + 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import identified, materialize, slices, texts_of
from skyledger.llm.components import components
from skyledger.llm.hashing import BASE, mix
from skyledger.llm.simhash import first_of_classes, links, majority, set_bits
from skyledger.llm.suffix_dedup import Runs, word_keys

SHINGLE = 5
# Bits of a parity bitmap, and of a finer one for each shingle of a set.
BITS, FINER = 1024, 4
# Chance that two sets are taken for similar that are not: e to the power of this.
DOUBT = -36.0
# Texts of a group that one task compares, and runs that a task remembers to send them once.
LARGE, REMEMBERED = 4096, 1 << 20
# Texts of the sample, in how many of them a shingle is frequent, and the most that are so.
SAMPLED, FREQUENT, MOST_FREQUENT = 4000, 8, 1 << 16


def shingles(text: str) -> np.ndarray:
    """Sorted hashes of the different shingles; a shorter text is one, a text of no word none."""
    words = word_keys(text)
    size = min(SHINGLE, len(words))
    if not size:
        return words
    return np.unique(Runs(words).hashes(np.arange(len(words) - size + 1), size))


def fingerprint(found: np.ndarray) -> int:
    """The SimHash of a set of shingles, as a signed number; 0 without any."""
    return int(np.uint64(majority(set_bits(found), len(found))).view(np.int64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets share 0.8 of their union or more."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * shared >= 4 * (len(a) + len(b) - shared)


def parity(found: np.ndarray, size: int) -> np.ndarray:
    """Bitmap of the remainders that an odd number of hashes have."""
    odd = np.bincount((found % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8))


def fine_size(n: int) -> int:
    return max(BITS, 1 << (FINER * n - 1).bit_length() if n else BITS)


def _folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    """The bitmap of the same set for a smaller size, both powers of two."""
    return np.bitwise_xor.reduce(bitmap.reshape(-1, size // 8), axis=0)


@lru_cache(maxsize=1 << 14)
def sure_bits(sizes: int, size: int) -> int:
    """Most bits that bitmaps of sets with `sizes` shingles in all may differ in to be similar for sure.

    More than `most` different shingles differ in fewer bits only where two of them meet in a
    bit, which takes both away. The number of such meetings is nearly a Poisson variable; `met` is
    so large that more have a chance below DOUBT.
    """
    most = sizes // 9 + 1
    mean = most * most / (2 * size)
    met = math.ceil(mean) + 1
    while -mean + met * (1 + math.log(mean / met)) > DOUBT:
        met += 1
    return most - 2 * met


def judged(n_a: int, a: bytes, n_b: int, b: bytes) -> bool | None:
    """Whether two sets are similar, by their sizes and fine bitmaps; None if these leave it open."""
    a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = 8 * min(len(a), len(b))
    differ = int(np.bitwise_count(_folded(a, size) ^ _folded(b, size)).sum())
    if 9 * differ > n_a + n_b:
        return False
    return True if differ <= sure_bits(n_a + n_b, size) else None


def _frequent(texts: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(text) for text in texts_of(batch)]
            yield pa.RecordBatch.from_pydict(
                {"hash": pa.array(np.concatenate(found).view(np.int64))})

    every = max(1, texts.count() // SAMPLED)
    sample = texts.where(F.pmod("text_key", F.lit(every)) == 0).select("text")
    counts = sample.mapInArrow(run, "hash bigint").groupBy("hash").count()
    rows = (counts.where(F.col("count") >= FREQUENT)
            .orderBy(F.desc("count"), "hash").limit(MOST_FREQUENT).collect())
    return np.sort(np.array([row["hash"] for row in rows], np.int64).view(np.uint64))


def _sets(frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, sizes, fps, bits, fine, first = [], [], [], [], [], []
            for text in texts_of(batch):
                found = shingles(text)
                names.append(int(mix(mix(found + np.uint64(BASE)).sum(keepdims=True)
                                     + np.uint64(len(found)))[0]))
                sizes.append(len(found))
                fps.append(fingerprint(found))
                finest = parity(found, fine_size(len(found)))
                bits.append(_folded(finest, BITS).tobytes())
                fine.append(finest.tobytes())
                late = np.isin(found, frequent)
                ordered = np.concatenate([found[~late], found[late]])
                first.append(ordered[:len(found) // 5 + 2].view(np.int64))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"),
                "name": pa.array(np.array(names, np.uint64).view(np.int64)),
                "n": pa.array(sizes, pa.int32()), "fp": pa.array(fps, pa.int64()),
                "bits": pa.array(bits, pa.binary()),
                "fine": pa.array(fine, pa.binary()),
                "first": pa.array(first, pa.list_(pa.int64()))})
    return run


def _pairs(stars: bool):
    """Pairs of a group that may be similar and have different roots.

    With `stars` each member is in one pair at most in which it is not the centre.
    """
    def of_group(names, roots, sizes, bits) -> Iterator[tuple[int, int]]:
        free = np.ones(len(names), bool)
        for i in range(len(names) - 1):
            if stars and not free[i]:
                continue
            n, others = sizes[i], sizes[i + 1:]
            fits = (roots[i + 1:] != roots[i]) & (
                5 * np.minimum(n, others) >= 4 * np.maximum(n, others))
            if stars:
                fits &= free[i + 1:]
            at = np.flatnonzero(fits) + i + 1
            differ = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64)
            at = at[9 * differ <= n + sizes[at]]
            free[at] = False
            for j in at:
                yield int(names[i]), int(names[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows so far of the group that is being read

        def close() -> pa.RecordBatch:
            columns = [np.concatenate([part.column(c).to_numpy() for part in held])
                       for c in ("name", "root", "n")]
            bits = b"".join(bitmap for part in held for bitmap in part.column("bits").to_pylist())
            held.clear()
            found = list(of_group(*columns, np.frombuffer(bits, "<u8").reshape(len(columns[0]), -1)))
            return pa.RecordBatch.from_pydict({
                "a": pa.array([a for a, _ in found], pa.int64()),
                "b": pa.array([b for _, b in found], pa.int64())})

        group = None
        for batch in batches:
            groups = batch.column("g").to_numpy()
            if not len(groups):
                continue
            edges = np.flatnonzero(np.diff(groups, prepend=~groups[:1]))
            for start, end in zip(edges, [*edges[1:], len(groups)], strict=True):
                if held and groups[start] != group:
                    yield close()
                group = groups[start]
                held.append(batch.slice(start, end - start))
        if held:
            yield close()
    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, shingle, name) of the texts of each shingle that several have; rows come by both.

    Shingles of the same texts are one group, named after its texts, without a shingle. A run that is
    large, or may go on in another task, is named after its shingle, so that its parts meet again.
    """
    seen: set[int] = set()
    out: tuple[list[int], list[int | None], list[int]] = ([], [], [])
    run, names, ends, long = None, [], True, False

    def send(group: int, shingle: int | None = None) -> None:
        out[0].extend([group] * len(names))
        out[1].extend([shingle] * len(names))
        out[2].extend(names)

    def own(shingle: int) -> int:
        return int(mix(np.array([shingle], np.int64).view(np.uint64)).view(np.int64)[0])

    def close(last: bool) -> None:
        if run is None:
            return
        if ends or long or last:
            send(own(run), run)
        elif len(names) > 1:
            array = np.array(names, np.int64).view(np.uint64)
            group = int(mix(mix(array + np.uint64(BASE)).sum(keepdims=True)).view(np.int64)[0])
            if group not in seen:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(group)
                send(group)

    def batch() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()) for column in out], names=["g", "shingle", "name"])
        for column in out:
            column.clear()
        return rows

    for rows in batches:
        for shingle, name in zip(rows.column("hash").to_pylist(), rows.column("name").to_pylist(),
                                 strict=True):
            if shingle != run:
                close(False)
                ends = run is None
                run, names, long = shingle, [name], False
            elif name != names[-1]:
                names.append(name)
                if len(names) > LARGE:
                    long = True
                    send(own(run), run)
                    names = names[-1:]
        yield batch()
    close(True)
    yield batch()


def _told(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """a, b and whether they are similar (null: open), by sizes and fine bitmaps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n_a", "fine_a", "n_b", "fine_b")]
            told = [judged(*row) for row in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(told, pa.bool_())],
                names=["a", "b", "similar"])

    for end in ("a", "b"):
        pairs = pairs.join(sketches.select(
            F.col("name").alias(end), F.col("n").alias(f"n_{end}"),
            F.col("fine").alias(f"fine_{end}")), end)
    return materialize(pairs.mapInArrow(run, "a bigint, b bigint, similar boolean"), "told-pairs")


def _confirmed(pairs: DataFrame, docs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those of the pairs whose texts are similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a"):
            hit = [similar(shingles(a), shingles(b)) for a, b in zip(
                texts_of(batch, "text_a"), texts_of(batch, "text_b"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    told = _told(pairs, sketches)
    left = told.where("similar is null").select("a", "b")
    wanted = left.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    holders = wanted.join(sketches.select("name", "k.*"), "name").select(
        "name", F.col("doc_id").alias("held_id"), F.col("text_key").alias("held_key"))
    texts = docs.join(holders, docs["doc_id"].eqNullSafe(holders["held_id"]) & (
        docs["text_key"] == holders["held_key"])).select("name", "text")
    texts = materialize(texts.dropDuplicates(["name"]), "texts-of-pairs")
    for end in ("a", "b"):
        left = left.join(texts.select(
            F.col("name").alias(end), F.col("text").alias(f"text_{end}")), end)
    return told.where("similar").select("a", "b").unionAll(
        materialize(left.mapInArrow(run, "a bigint, b bigint"), "confirmed"))


def _linked(sketches: DataFrame) -> DataFrame:
    """Pairs of texts whose fingerprints are equal or link: each fingerprint has one of its texts for it."""
    owners = materialize(sketches.groupBy("fp").agg(F.min("name").alias("owner")), "owners")
    equal = sketches.join(owners, "fp").where(F.col("name") != F.col("owner")).select(
        F.col("owner").alias("a"), F.col("name").alias("b"))
    pairs = links(owners.select("fp"))
    for end in ("a", "b"):
        pairs = pairs.join(owners.select(F.col("fp").alias(end), F.col("owner").alias(f"own_{end}")), end)
    near = pairs.select(F.least("own_a", "own_b").alias("a"), F.greatest("own_a", "own_b").alias("b"))
    return materialize(equal.unionAll(near).distinct(), "linked")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and root of every row; rows of one class have the same root."""
    docs = identified(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]))
    rows = materialize(docs.mapInArrow(
        _sets(_frequent(docs)), "doc_id bigint, text_key bigint, name bigint, n int, "
        "fp bigint, bits binary, fine binary, first array<bigint>"), "shingle-sets")
    sketches = materialize(rows.groupBy("name").agg(
        F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bits").alias("bits"), F.first("fine").alias("fine"),
        F.min(F.struct("doc_id", "text_key")).alias("k")), "sketches")
    # one shingle more than is needed for a group, for those that are split
    needed = F.slice("first", 1, F.greatest(F.least(F.col("n"), F.floor(F.col("n") / 5) + 1), F.lit(1)))
    places = rows.select(F.explode(needed).alias("hash"), "name")
    members = materialize(
        places.repartitionByRange("hash", "name").sortWithinPartitions("hash", "name")
        .mapInArrow(_runs, "g bigint, shingle bigint, name bigint").distinct(), "groups")
    large = materialize(members.groupBy("g").agg(
        F.count("*").alias("texts"), F.min("name").alias("centre")).where(
            F.col("texts") > LARGE).select("g", "centre"), "large-groups")

    def pairs(of: DataFrame, known: DataFrame, stars: bool) -> DataFrame:
        # rows of a group come one after the other, so a task holds one group at a time
        rows = of.join(known, "name").select(
            "g", "name", F.col("n").cast("bigint").alias("n"), "bits", "root")
        found = rows.repartition("g").sortWithinPartitions("g", "name").mapInArrow(
            _pairs(stars), "a bigint, b bigint").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return materialize(found.distinct(), "pairs")

    def roots(edges: DataFrame) -> DataFrame:
        return materialize(components(edges).select(F.col("node").alias("name"), "root"), "roots")

    def mixed(groups: DataFrame) -> DataFrame:
        """The groups whose texts are in different classes."""
        several = groups.groupBy("g").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        return groups.join(several.where("low <> high").select("g"), "g")

    linked = _confirmed(_linked(sketches), docs, sketches)
    small = members.join(large, "g", "left_anti")
    sizes = sketches.select("name", "n", "bits")
    rooted = sizes.join(roots(linked), "name", "left").withColumn(
        "root", F.coalesce("root", "name"))
    spokes = members.join(large, "g").where(F.col("name") != F.col("centre")).select(
        F.col("centre").alias("a"), F.col("name").alias("b")).distinct()
    edges = linked.unionAll(
        _confirmed(pairs(small, rooted, True).unionAll(spokes), docs, sketches))
    known = mixed(materialize(members.join(roots(edges), "name", "left").select(
        "g", "shingle", "name", F.coalesce("root", "name").alias("root")), "known"))
    split = known.join(large, "g").join(
        rows.select("name", F.explode("first").alias("second")), "name").where(
            ~F.col("second").eqNullSafe(F.col("shingle"))).select(
                F.xxhash64("g", "second").alias("g"), "name", "root").distinct()
    left = known.join(large, "g", "left_anti").select("g", "name", "root").unionAll(
        mixed(materialize(split, "split-groups")).select("g", "name", "root"))
    others = _confirmed(pairs(left, sizes, False), docs, sketches)
    return rows.select("doc_id", "text_key", "name").join(
        roots(edges.unionAll(others)), "name", "left").select(
            "doc_id", "text_key", F.coalesce("root", "name").alias("root"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class of near copies, with all its columns: that of the smallest doc_id.

    `docs` has doc_id and text. Words are cut at ASCII white space after A-Z are lower-cased;
    classes are closed under similarity in steps. Texts without a word, null ones too, are
    one class. A class without any doc_id keeps the text of smallest hash; of repeated rows one
    stays. A very long text is compared whole, by all its shingles. An empty table gives an empty
    result.
    """
    return first_of_classes(docs, classes(docs))
