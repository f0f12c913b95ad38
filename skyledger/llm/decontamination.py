"""Benchmark decontamination by winnowing.

Of the hashes of K consecutive words, the least in each window of six is a fingerprint, the
leftmost if equal. Ten words hold six such hashes, so wherever a document repeats ten words of
a benchmark item both keep the same fingerprint at the same place in them: no shared span of
ten words or more is missed. A fingerprint that both sides have is extended over the ten words
around it by comparing the hashes that start and end there, 128 bits in all.

Only built-in expressions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import identified, materialize

WINDOW, K = 10, 5
WIDTH = WINDOW - K + 1
# Benchmark windows that are sent to every task, at most; 40 bytes each. More are joined by
# shuffling the documents' fingerprints.
SENT_WINDOWS = 500_000
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOC = ["doc_id", "text_key"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, NOT_A_WORD), "")


def _hash(words: Column, at: Column | int, size: int, salt: int | None = None) -> Column:
    """Hash of `size` words from the 0-based position `at`."""
    parts = [F.get(words, at + i if isinstance(at, Column) else F.lit(at + i))
             for i in range(size)]
    return F.xxhash64(*([] if salt is None else [F.lit(salt)]), *parts)


def _positions(count: Column) -> Column:
    """0, 1, ... below `count`, as an array; empty if there are none."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>"))


def _least(hashes: Column, start: Column) -> Column:
    """Position of the leftmost least hash of the window that starts at `start`."""
    return _let(F.slice(hashes, start + 1, WIDTH), lambda window: (
        start + F.array_position(window, F.array_min(window)).cast("int") - 1))


def windows_of(benchmark: DataFrame) -> DataFrame:
    """item_id, size and words of every window of ten item words, or of a shorter whole item."""
    items = benchmark.select("item_id", words_of(benchmark["text"]).alias("words"))
    size = F.least(F.size("words"), F.lit(WINDOW))
    starts = _positions(F.when(F.size("words") > 0, F.size("words") - size + 1).otherwise(0))
    return items.select("item_id", "words", size.alias("size"), F.explode(starts).alias("at")).select(
        "item_id", "size", F.slice("words", F.col("at") + 1, F.col("size")).alias("words"))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """One row for each different window, and the items that have it, written once.

    least: the fingerprint's hash, place: its place in the window (both of ten words only);
    first and second: two hashes that together stand for all the words.
    """
    found = windows_of(benchmark)
    ends = (F.when(F.col("size") == WINDOW, _hash(F.col("words"), 0, K)),
            F.when(F.col("size") == WINDOW, _hash(F.col("words"), K, K)))
    short = [F.when(F.col("size") == n, _hash(F.col("words"), 0, n, salt))
             for salt in (None, 1) for n in range(1, WINDOW)]
    half = len(short) // 2
    hashes = F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)),
                         lambda i: _hash(F.col("words"), i, K))
    placed = found.select(
        "item_id", "size", F.coalesce(ends[0], *short[:half]).alias("first"),
        F.coalesce(ends[1], *short[half:]).alias("second"),
        F.when(F.col("size") == WINDOW, hashes).alias("hashes"))
    placed = placed.withColumn("least", F.array_min("hashes")).withColumn(
        "place", (F.array_position("hashes", F.col("least")) - 1).cast("int")).drop("hashes")
    keys = ["size", "first", "second", "least", "place"]
    return materialize(placed.select("item_id", *keys).distinct(), "benchmark")


def _document_rows(docs: DataFrame) -> DataFrame:
    """One row for each fingerprint of a document and one more, at -1, with its word count.

    around: the hashes from five places before the fingerprint to five behind it. The extra
    row has a key that no other row has, so that it is no hot key in a shuffle.
    """
    def rows(words: Column) -> Column:
        hashes = F.transform(
            _positions(F.size(words) - K + 1), lambda i: _hash(words, i, K))
        count = F.struct(F.lit(-1).alias("at"), F.size(words).alias("n_words"),
                         F.lit(None).cast("array<bigint>").alias("around"))

        def fingerprints(h: Column) -> Column:
            places = F.array_distinct(F.transform(
                _positions(F.size(words) - WINDOW + 1), lambda start: _least(h, start)))
            zeros = F.array(*[F.lit(0).cast("bigint")] * K)
            return _let(F.concat(zeros, h, zeros), lambda padded: F.transform(
                places, lambda at: F.struct(
                    at.alias("at"), F.lit(0).alias("n_words"),
                    F.slice(padded, at + 1, 2 * K + 1).alias("around"))))

        return F.concat(F.array(count), _let(hashes, fingerprints))

    exploded = docs.select(*DOC, F.explode(_let(words_of(docs["text"]), rows)).alias("r"))
    least = F.coalesce(F.element_at("r.around", K + 1), F.col("text_key"))
    return exploded.select(*DOC, "r.*", least.alias("least"))


def _short_hits(docs: DataFrame, short: DataFrame, sizes: list[int]) -> DataFrame:
    """Places of items shorter than a window: every run of so many words is looked up."""
    def of_size(words: Column, size: int) -> Column:
        return F.transform(_positions(F.size(words) - size + 1), lambda at: F.struct(
            at.alias("start"), F.lit(size).alias("size"),
            _hash(words, at, size).alias("first"), _hash(words, at, size, 1).alias("second")))

    def runs(words: Column) -> Column:
        return F.concat(*(of_size(words, size) for size in sizes))

    rows = docs.select(*DOC, F.explode(_let(words_of(docs["text"]), runs)).alias("r"))
    return rows.select(*DOC, "r.*").join(short, ["size", "first", "second"]).select(
        *DOC, "start", "size", "window")


def _covered(spans: Column) -> Column:
    """Words under at least one of the (start, size) spans."""
    begin = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("total"))

    def add(state: Column, span: Column) -> Column:
        reach = F.greatest(state["reach"], span["start"] + span["size"])
        fresh = reach - F.greatest(state["reach"], span["start"])
        return F.struct(reach.alias("reach"), (state["total"] + F.greatest(
            fresh, F.lit(0))).alias("total"))

    return F.aggregate(F.sort_array(spans), begin, add, lambda state: state["total"])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, n_items, items_sha256 and contaminated.

    `docs` has doc_id and text, `benchmark` has item_id and text; other columns are not read,
    whatever their names. One row for each input row; rows that agree in doc_id and text have equal
    results. A null or empty text has no words and no hits, and an item without words has no
    windows. A null item_id hits but is not listed. Items with equal windows all count. Very long
    texts are read whole, as rows of their fingerprints. Empty tables give no rows or no hits.
    """
    texts = identified(docs)
    of_items = benchmark_windows(benchmark)
    keys = ["size", "first", "second"]
    window = F.xxhash64(*keys).alias("window")
    windows = of_items.drop("item_id").distinct().select("*", window)
    known = windows.count()
    sizes = [row.size for row in windows.select("size").distinct().collect()]
    send = F.broadcast if known <= SENT_WINDOWS else (lambda df: df)
    full = windows.where(F.col("size") == WINDOW)
    marks = full.select("least", F.lit(True).alias("marked")).distinct()
    rows = materialize(
        _document_rows(texts).join(send(marks), "least", "left").where(
            F.col("marked") | (F.col("at") < 0)).drop("least", "marked"), "fingerprint-hits")
    places = F.array(*(F.struct(
        F.lit(j).alias("place"), F.element_at("around", WIDTH - j).alias("first"),
        F.element_at("around", WIDTH - j + K).alias("second")) for j in range(WIDTH)))
    tried = rows.where(F.col("at") >= 0).select(*DOC, "at", F.explode(places).alias("c")).select(
        *DOC, (F.col("at") - F.col("c.place")).alias("start"), "c.*")
    hits = tried.join(send(full.drop("least")), ["place", "first", "second"]).select(
        *DOC, "start", "size", "window")
    short = sorted(size for size in sizes if size < WINDOW)
    if short:
        hits = hits.unionAll(_short_hits(texts, send(windows.where(
            F.col("size") < WINDOW).select(*keys, "window")), short))
    spans = hits.select(*DOC, F.struct("start", "size").alias("span"), "window",
                        F.lit(0).alias("n_words"))
    counts = rows.where(F.col("at") < 0).select(
        *DOC, F.lit(None).cast("struct<start:int,size:int>").alias("span"),
        F.lit(None).cast("bigint").alias("window"), "n_words")
    found = materialize(
        spans.unionAll(counts).groupBy(*DOC).agg(
            F.max("n_words").cast("bigint").alias("n_words"),
            F.count(F.when(F.col("span").isNull(), 1)).alias("copies"),
            _covered(F.collect_set("span")).cast("bigint").alias("n_hit"),
            F.sort_array(F.collect_set("window")).alias("windows")), "hit-documents")
    return _repeated(_with_items(found, of_items.select("item_id", window)))


def _repeated(found: DataFrame, step: int = 4096) -> DataFrame:
    """As many rows as `copies` says, dealt out in steps so that no row holds a long array."""
    last = F.col("copies") - 1
    steps = found.withColumn("step", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(step).cast("bigint"))))
    rows = F.sequence(F.col("step"), F.least(F.col("step") + (step - 1), last))
    return steps.withColumn("row", F.explode(rows)).drop("step", "row", "copies")


def _with_items(found: DataFrame, of_items: DataFrame) -> DataFrame:
    """The items of each document, worked out once for each different set of windows."""
    hit = F.size("windows") > 0
    sets = found.where(hit).select("windows").distinct()
    ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    listed = (sets.select("windows", F.explode("windows").alias("window"))
              .join(of_items, "window").groupBy("windows").agg(ids.alias("ids")))
    named = listed.select("windows", F.size("ids").cast("bigint").alias("n_items"),
                          F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))
    clean = found.where(~hit).select(
        *DOC, "n_words", "n_hit", "copies", F.lit(0).cast("bigint").alias("n_items"),
        F.sha2(F.lit(""), 256).alias("items_sha256"))
    both = clean.unionAll(found.where(hit).join(named, "windows").select(*clean.columns))
    return both.withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, of documents without a benchmark window."""
    hit = decontaminate(docs, benchmark).where("contaminated").select(
        F.col("doc_id").alias("hit_id_"), F.col("text_key").alias("hit_key_"))
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["hit_id_"]) & (key == hit["hit_key_"]),
                     "left_anti")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{word}') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{word}') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[p:p + 9], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0)),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
hits AS (
  SELECT doc_id, p, size, item_id
  FROM (SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS g
        FROM starts, (SELECT DISTINCT size FROM windows) WHERE p + size - 1 <= len(w))
  JOIN windows USING (size, g)),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""".replace("{upper}", UPPER).replace("{lower}", LOWER).replace(
    "{word}", NOT_A_WORD.replace("[", "[^", 1))
