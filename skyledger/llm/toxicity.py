"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, drops accents and invisible characters, and maps look-alike letters and
digit substitutions to one character each, for the lexicon and the texts alike. The lexicon
and its weights are learnt from labelled documents, and so is the curve from weight and
length to a score. Words inside an exception phrase do not count.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import bucket_of, free_name, materialize, slices, texts_of

# Labelled documents that the lexicon is learnt from, at most; those of smallest id hash.
SAMPLE_ROWS = 20_000
# A word or stem enters the lexicon if at least this many of its different surroundings are toxic, as
# a share of all of them and in standard deviations above the share of toxic documents.
LEAST_SUPPORT, LEAST_SHARE, LEAST_Z = 8, 0.9, 6.0
# Bytes of text whose entries a task counts at once.
COUNTED_BYTES = 1 << 20
# Lengths of the stems that a whole family of words may share, and their mark in a lexicon.
STEMS, STEM = (3, 7), "*"
# A phrase of a lexicon word and a neighbour is an exception below this share.
EXCEPTION_SHARE = 0.2

# Characters read as another letter. i, l, 1, ! and | are one class.
LOOK_ALIKES = {
    "i": "lı1!|¡ιіΙІǀӀ", "a": "4@αаɑАΑ", "b": "8ЬьВΒв", "c": "сϲСⅽ", "d": "ԁⅾ", "e": "3€еєЕΕε",
    "g": "9ɡ", "h": "һНΗн", "j": "јЈ", "k": "κкКΚ", "m": "мМΜⅿ", "n": "ոΝп", "o": "0οоОΟօσ",
    "p": "рРΡρ", "q": "ԛ", "r": "гꭇ", "s": "5$ѕЅꜱ", "t": "7+тТΤτ", "u": "υսц", "v": "νѵⅴ",
    "w": "ԝωш", "x": "×хХΧχ", "y": "уУΥγү", "z": "2ᴢΖ",
}
INVISIBLE = re.compile("[\u0300-\u036f\u00ad\u200b-\u200f\u2060\ufeff]+")
SPACE = " "


class _Folding(dict):
    """Code point to folded code point, worked out when first asked for."""

    def __init__(self) -> None:
        super().__init__()
        self._same = {c: ord(to) for to, group in LOOK_ALIKES.items() for c in group}

    def __missing__(self, point: int) -> int:
        char = chr(point)
        if char.isspace():
            folded = ord(SPACE)
        else:
            plain = unicodedata.normalize("NFKD", char)[0].lower()[:1] or char
            folded = self._same.get(char) or self._same.get(plain) or ord(plain)
        if len(self) < 100_000:
            self[point] = folded
        return folded


_FOLDING = _Folding()
WORD = re.compile(r"[^\W_](?:[\w@$!|+]*[^\W_])?")


def fold(text: str) -> tuple[str, str]:
    """The text without invisible characters, and its folded form of the same length."""
    if not text.isascii() and INVISIBLE.search(text):
        text = INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
        text = INVISIBLE.sub("", text)
    return text, text.translate(_FOLDING)


def folded_words(text: str) -> list[str]:
    clean, folded = fold(text)
    return [folded[m.start():m.end()] for m in WORD.finditer(clean)]


def features(word: str) -> list[str]:
    """What a word may match: the word itself, and each proper stem of it, marked by a star."""
    stems = [word[:size] + STEM for size in range(STEMS[0], min(len(word) - 1, STEMS[1]) + 1)]
    return [word, *stems] if len(word) >= STEMS[0] else []


@dataclass
class Lexicon:
    """Folded words and stems with weights, folded exception phrases, and the curve to a score."""

    weights: dict[str, float]
    exceptions: Sequence[str] = ()
    intercept: float = -3.0
    of_weight: float = 1.0
    of_density: float = 0.5

    def score(self, weight: float, words: int) -> float:
        z = self.intercept + self.of_weight * math.log1p(weight)
        z += self.of_density * density(weight, words)
        return 1.0 / (1.0 + math.exp(-min(max(z, -30.0), 30.0)))


def density(weight: float, words: int) -> float:
    """Weight in proportion to the length, on a log scale; a text counts as 20 words or more."""
    return math.log1p(100.0 * weight / max(words, 20))


class Matcher:
    """All words, stems and phrases in one Aho-Corasick automaton."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self._automaton = ahocorasick.Automaton()
        entries: dict[str, tuple[int, float | None, bool]] = {}
        for entry, weight in lexicon.weights.items():
            plain = entry.removesuffix(STEM)
            entries[plain] = (len(plain), weight, entry.endswith(STEM))
        for phrase in lexicon.exceptions:
            entries[phrase] = (len(phrase), None, False)
        for plain, found in entries.items():
            if plain:
                self._automaton.add_word(plain, found)
        self._empty = not len(self._automaton)
        if not self._empty:
            self._automaton.make_automaton()

    def measure(self, text: str) -> tuple[float, int, int]:
        """Weight of the counted matches, their number, and the words of the text.

        A match counts if no letter or digit of the unfolded text touches it; a stem may be
        followed by more of its word.
        """
        clean, folded = fold(text)
        words = len(clean.split())
        if self._empty:
            return 0.0, 0, words
        hits, excused, size = [], [], len(clean)
        for end, (length, weight, stem) in self._automaton.iter(folded):
            start = end - length + 1
            if (start and clean[start - 1].isalnum()) or (
                    not stem and end + 1 < size and clean[end + 1].isalnum()):
                continue
            (excused if weight is None else hits).append((start, end, weight))
        total, count, at, reach = 0.0, 0, 0, -1
        excused.sort()
        for start, end, weight in sorted(hits, key=lambda hit: hit[:2]):
            while at < len(excused) and excused[at][0] <= start:
                reach = max(reach, excused[at][1])
                at += 1
            if end > reach:
                total += weight
                count += 1
        return total, count, words


def training_sample(docs: DataFrame, labels: DataFrame, label: str, trains: Column,
                    rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and y of at most `rows` labelled documents, written once.

    A document labelled more than once takes the largest label; null labels and ids are left
    out. The ids are bounded by `rows`, so they are broadcast.
    """
    picked = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & trains)
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return materialize(found.select("text", "y"), "labelled")


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most=COUNTED_BYTES):
        counts = {0: Counter(), 1: Counter()}
        for text, y in zip(texts_of(batch), batch.column("y").to_pylist(), strict=True):
            words = set(folded_words(text))
            counts[int(bool(y))].update(set(chain.from_iterable(map(features, words))))
        entries = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_pydict({
            "entry": pa.array(entries, pa.string()),
            "toxic": pa.array([counts[1][entry] for entry in entries], pa.int64()),
            "clean": pa.array([counts[0][entry] for entry in entries], pa.int64())})


def _surroundings(wanted: set[str]):
    """Each candidate entry with the word it matches and the words beside it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=COUNTED_BYTES):
            rows = set()
            for text, y in zip(texts_of(batch), batch.column("y").to_pylist(), strict=True):
                words = ["", *folded_words(text), ""]
                for i, word in enumerate(words):
                    for entry in features(word):
                        if entry in wanted:
                            rows.add((entry, word, words[i - 1], words[i + 1], int(bool(y))))
            names = ("entry", "word", "before", "after", "y")
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
    return run


def _log_odds(toxic: Column, clean: Column, all_toxic: int, all_clean: int) -> Column:
    t, c = toxic + 0.5, clean + 0.5
    return F.log(t / (all_toxic - toxic + 0.5)) - F.log(c / (all_clean - clean + 0.5))


def learn_lexicon(sample: DataFrame, exceptions: Sequence[str] = ()) -> Lexicon:
    """The lexicon of a labelled sample (text, y).

    Copies of one text would make any of its words look toxic, so support counts different
    surroundings of a word and not documents. Without labels of both kinds nothing is learnt:
    every score is then the base rate, 0 or near 0 without a toxic label.
    """
    sizes = sample.agg(F.sum((F.col("y") > 0).cast("long")), F.count("*")).first()
    toxic, clean = sizes[0] or 0, (sizes[1] or 0) - (sizes[0] or 0)
    phrases = [fold(phrase)[1] for phrase in exceptions]
    if not toxic or not clean:
        return Lexicon({}, phrases, intercept=5.0 if toxic else -5.0)
    t, c = F.col("toxic"), F.col("clean")
    counted = (sample.mapInArrow(_document_counts, "entry string, toxic bigint, clean bigint")
               .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    likely = counted.where((t >= max(3, 0.002 * toxic)) & (t >= LEAST_SHARE * (t + c)))
    # a bounded sample has a bounded vocabulary, and few of its words pass
    odds = _log_odds(t, c, toxic, clean)
    weights = {row.entry: row.weight for row in likely.select(
        "entry", odds.alias("weight")).collect()}
    around = sample.mapInArrow(
        _surroundings(set(weights)),
        "entry string, word string, before string, after string, y int").distinct()
    support: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for row in around.groupBy("entry", "y").agg(F.count("*").alias("n")).collect():
        support[row.entry][row.y] += row.n
    kept = _chosen(support, toxic / (toxic + clean))
    phrases += _learnt_exceptions(around.where(F.col("entry").isin(kept)))
    lexicon = Lexicon({entry: weights[entry] for entry in kept}, phrases)
    _fit_curve(sample, lexicon)
    return lexicon


def _chosen(support: dict[str, list[int]], share: float) -> list[str]:
    """Entries with enough support; of a word and its stems the best supported, then longest."""
    passed = []
    for entry, (n_clean, n_toxic) in support.items():
        n = n_clean + n_toxic
        z = (n_toxic - n * share) / math.sqrt(n * share * (1 - share))
        if n_toxic >= max(LEAST_SUPPORT, LEAST_SHARE * n) and z >= LEAST_Z:
            passed.append((-n_toxic, -len(entry.removesuffix(STEM)), entry))
    kept: dict[str, None] = {}
    heads: set[str] = set()
    for _, _, entry in sorted(passed):
        plain = entry.removesuffix(STEM)
        own = {plain[:size] for size in range(STEMS[0], len(plain) + 1)}
        if plain in heads or any(head + STEM in kept for head in own):
            continue
        kept[entry] = None
        heads |= own
    return list(kept)


def _learnt_exceptions(around: DataFrame) -> list[str]:
    """Word pairs with a lexicon word that are mostly seen in clean documents."""
    pairs = around.select("y", F.explode(F.array(
        F.concat_ws(SPACE, "before", "word"), F.concat_ws(SPACE, "word", "after"))).alias("pair"))
    counted = pairs.groupBy("pair").agg(
        F.count("*").alias("n"), F.sum("y").alias("toxic"))
    rare = counted.where((F.col("n") >= LEAST_SUPPORT) & (
        F.col("toxic") < EXCEPTION_SHARE * F.col("n")))
    return [row.pair.strip() for row in rare.select("pair").collect() if SPACE in row.pair.strip()]


def _fit_curve(sample: DataFrame, lexicon: Lexicon) -> None:
    """Logistic regression of the label on weight and density, on rounded pairs of both."""
    matcher = Matcher(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [matcher.measure(text) for text in texts_of(batch)]
            x = [round(math.log1p(w), 1) for w, _, _ in found]
            d = [round(density(w, n), 1) for w, _, n in found]
            yield pa.RecordBatch.from_pydict({
                "x": pa.array(x, pa.float64()), "d": pa.array(d, pa.float64()),
                "y": batch.column("y")})

    grid = sample.mapInArrow(run, "x double, d double, y int").groupBy("x", "d").agg(
        F.count("*").alias("n"), F.sum((F.col("y") > 0).cast("int")).alias("toxic")).collect()
    design = np.array([[1.0, row.x, row.d] for row in grid])
    n = np.array([row.n for row in grid], float)
    toxic = np.array([row.toxic for row in grid], float)
    beta = np.zeros(3)
    ridge = np.diag([1e-6, 0.02, 0.02])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (toxic - n * p) - ridge @ beta
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    lexicon.intercept, lexicon.of_weight, lexicon.of_density = map(float, beta)


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score, predicted, n_hits and hit_weight of every text.

    `docs` has doc_id and text; other columns are not read, whatever their names. One row
    for each input row, repeats included. A null or empty text has no hits and gets the score
    of no hits; a very long text is matched whole, in one pass; an empty table gives an empty result.
    """
    matcher = Matcher(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [matcher.measure(text) for text in texts_of(batch)]
            scores = [lexicon.score(weight, words) for weight, _, words in found]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64()),
                "predicted": pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                "n_hits": pa.array([count for _, count, _ in found], pa.int64()),
                "hit_weight": pa.array([weight for weight, _, _ in found], pa.float64())})

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(
        run, "doc_id bigint, score double, predicted int, n_hits bigint, hit_weight double")


def score_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a lexicon learnt outside the held-out fifth."""
    sample = training_sample(docs, labels, "toxic", bucket_of("doc_id", 5) != 0)
    found = score(docs, learn_lexicon(sample))
    return found.select(
        "doc_id", (bucket_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted",
        "n_hits", "hit_weight")


def drop_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows, with all their columns, whose text is not predicted toxic."""
    matcher = Matcher(lexicon)

    @F.pandas_udf("boolean")
    def toxic(texts):
        return texts.map(
            lambda text: lexicon.score(*matcher.measure(text or "")[::2]) >= 0.5).astype(bool)

    flag = free_name(docs, "toxic")
    return docs.withColumn(flag, toxic(docs["text"])).where(~F.col(flag)).drop(flag)
