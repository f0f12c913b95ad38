"""Language identification in two levels.

The family of a text is predicted first; one-versus-one linear support vector machines then
tell the languages of that family apart. Features are shares of hashed character n-grams of
the lower-cased letters, so a machine's margin is a mean of weights over a text's n-grams and
whole batches of texts are scored by table lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import bucket_of, materialize, slices, texts_of

# Labelled texts that a language is learnt from, at most; those of smallest id hash.
ROWS_PER_LANGUAGE = 2_000
ORDERS = (1, 2, 3)
BITS = 14
# Weight of the penalty on a machine's weights, most steps of a fit, and the gain that ends it.
PENALTY, STEPS, TOLERANCE = 1e-3, 60, 1e-5
UNKNOWN = "und"
# Code points handled at once; n-grams of a longer text are added up piece by piece.
PIECE = 1 << 20

# Families of languages by ISO 639-1 code. Any other language is its own family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"), "celtic": ("br", "cy", "ga", "gd"), "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tk", "tr", "tt", "ug", "uz"),
    "semitic": ("am", "ar", "he", "mt"), "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "dravidian": ("kn", "ml", "ta", "te"), "iranian": ("fa", "ku", "ps", "tg"),
    "sinitic": ("yue", "zh"), "austronesian": ("id", "jv", "ms", "tl"),
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().split("-")[0], lang)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _points(text: str) -> np.ndarray:
    """Code points of the lower-cased text between two spaces, with 32 for every non-letter."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    return np.where(_letters()[points], points, 32).astype(np.uint64)


def _slots(points: np.ndarray) -> Iterator[np.ndarray]:
    """For each order, the feature of the n-gram that starts at each code point."""
    odd = np.uint64(0x9E3779B97F4A7C15)
    for order in ORDERS:
        count = max(0, len(points) - order + 1)
        code = np.full(count, order, np.uint64)
        for i in range(order):
            code = (code ^ points[i:count + i]) * odd
            code ^= code >> np.uint64(29)
        yield (code >> np.uint64(64 - BITS)).astype(np.int32)


def _slots_by_piece(points: np.ndarray) -> Iterator[np.ndarray]:
    """The features of every n-gram once, PIECE starts at a time."""
    for start in range(0, len(points), PIECE):
        last = start + PIECE >= len(points)
        for slots in _slots(points[start:start + PIECE + max(ORDERS) - 1]):
            yield slots if last else slots[:PIECE]


def _shares(text: str) -> tuple[list[int], list[float]] | None:
    """Feature slots of a text and their shares, or None without a letter."""
    points = _points(text)
    if not (points != 32).any():
        return None
    counts = np.zeros(1 << BITS)
    for slots in _slots_by_piece(points):
        counts += np.bincount(slots, minlength=1 << BITS)
    found = np.flatnonzero(counts)
    return found.tolist(), (counts[found] / counts.sum()).tolist()


@dataclass
class Machine:
    """A linear support vector machine between two names; positive margins mean the second."""

    first: str
    second: str
    weights: np.ndarray
    bias: float


@dataclass
class Model:
    families: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]

    def machines(self) -> list[Machine]:
        return [*self.between, *(m for group in self.within.values() for m in group)]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        langs = batch.column("lang").to_pylist()
        found = [(lang, shares) for lang, text in zip(langs, texts_of(batch), strict=True)
                 if (shares := _shares(text))]
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([lang for lang, _ in found], pa.string()),
            "slots": pa.array([s for _, (s, _) in found], pa.list_(pa.int32())),
            "shares": pa.array([s for _, (_, s) in found], pa.list_(pa.float64()))})


def training_sample(docs: DataFrame, trains: Column, rows: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """lang and feature vector of at most `rows` labelled texts of each language, written once.

    Rows with a null or empty lang, or without a letter, teach nothing. A language's texts are
    thinned out by their hash to about half as many again as are wanted before any is
    shuffled, so a language with most of the rows is no burden.
    """
    labelled = docs.where(F.col("lang").isNotNull() & (F.col("lang") != "") & trains)
    sizes = {row.lang: row["count"] for row in labelled.groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for lang, size in sizes.items():  # one row for each language
        share = F.when(F.col("lang") == lang, 1.5 * rows / size).otherwise(share)
    order = F.xxhash64("doc_id", "text")
    drawn = F.pmod(order, F.lit(1 << 30)) < share * (1 << 30)
    first = Window.partitionBy("lang").orderBy(order)
    kept = (labelled.where(drawn & F.col("text").rlike(r"\p{L}"))
            .withColumn("n", F.row_number().over(first)).where(F.col("n") <= rows))
    found = kept.select("lang", "text").mapInArrow(
        _features, "lang string, slots array<int>, shares array<double>")
    return materialize(found, "languages")


def _minimised(value_and_slope, start: np.ndarray, steps: int, memory: int = 10) -> np.ndarray:
    """A minimum of a smooth convex function, by limited-memory quasi-Newton steps."""
    at, (value, slope) = start, value_and_slope(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, shares = slope.copy(), []
        for move, turn in reversed(moves):
            share = (move @ way) / (move @ turn)
            shares.append(share)
            way -= share * turn
        if moves:
            move, turn = moves[-1]
            way *= (move @ turn) / (turn @ turn)
        for (move, turn), share in zip(moves, reversed(shares), strict=True):
            way += (share - (turn @ way) / (move @ turn)) * move
        fall, length = slope @ way, 1.0 if moves else 1.0 / max(np.linalg.norm(slope), 1e-12)
        while True:
            there, (lower, new_slope) = at - length * way, value_and_slope(at - length * way)
            if lower <= value - 1e-4 * length * fall:
                break
            length /= 2
            if length < 1e-10:
                return at
        if new_slope @ (there - at) - slope @ (there - at) > 1e-12:
            moves = [*moves, (there - at, new_slope - slope)][-memory:]
        done = value - lower < TOLERANCE * max(abs(value), 1e-12)
        at, value, slope = there, lower, new_slope
        if done:
            break
    return at


def support_vectors(
    rows: np.ndarray, slots: np.ndarray, shares: np.ndarray, second: np.ndarray,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine: squared hinge loss over scaled features.

    Entry i is the feature slots[i] of text rows[i]; `second` tells which texts are of the
    second class. Features are divided by their deviation.
    """
    texts, size = len(second), 1 << BITS
    sign = np.where(second, 1.0, -1.0)
    mean = np.bincount(slots, shares, size) / texts
    deviation = np.sqrt(np.maximum(np.bincount(slots, shares * shares, size) / texts - mean * mean, 0))
    scale = np.divide(1.0, deviation, out=np.zeros(size), where=deviation > 0)
    scaled = shares * scale[slots]

    def value_and_slope(model: np.ndarray) -> tuple[float, np.ndarray]:
        margins = np.bincount(rows, scaled * model[slots], texts) + model[-1]
        short = np.maximum(1.0 - sign * margins, 0.0)
        pull = -2.0 * sign * short / texts
        slope = np.bincount(slots, scaled * pull[rows], size + 1)
        slope[:-1] += PENALTY * model[:-1]
        slope[-1] = pull.sum()
        return (short @ short) / texts + PENALTY / 2 * (model[:-1] @ model[:-1]), slope

    found = _minimised(value_and_slope, np.zeros(size + 1), STEPS)
    return found[:-1] * scale, float(found[-1])


def _fitted(table: pa.Table) -> pa.Table:
    """The weights and the bias of one machine, from the texts of its two sides."""
    slots = table["slots"].combine_chunks()
    sizes = pa.compute.list_value_length(slots).to_numpy()
    weights, bias = support_vectors(
        np.repeat(np.arange(len(sizes)), sizes), slots.flatten().to_numpy(),
        table["shares"].combine_chunks().flatten().to_numpy(), table["second"].to_numpy())
    return pa.table({"machine": table["machine"].slice(0, 1),
                     "weights": pa.array([weights.astype(np.float32)], pa.list_(pa.float32())),
                     "bias": pa.array([bias], pa.float64())})


def learn(sample: DataFrame) -> Model:
    """The machines between families, and between the languages of each family.

    All are fitted by one job, each by one task from the texts of its two sides, at most
    ROWS_PER_LANGUAGE of a language.
    """
    languages = sorted(row.lang for row in sample.select("lang").distinct().collect())
    families: dict[str, list[str]] = {}
    for lang in languages:
        families.setdefault(family_of(lang), []).append(lang)
    sides = [(a, families[a], b, families[b]) for a, b in combinations(families, 2)]
    between = len(sides)
    for langs in families.values():
        sides += [(a, [a], b, [b]) for a, b in combinations(langs, 2)]
    parts = [(lang, machine, lang in seconds) for machine, (_, firsts, _, seconds) in enumerate(sides)
             for lang in (*firsts, *seconds)]
    wanted = sample.sparkSession.createDataFrame(parts, "lang string, machine int, second boolean")
    fitted = (sample.join(wanted, "lang").select("machine", "second", "slots", "shares")
              .groupBy("machine").applyInArrow(
                  _fitted, "machine int, weights array<float>, bias double")).toArrow()
    found = {machine: (weights, bias) for machine, weights, bias in zip(
        fitted["machine"].to_pylist(), fitted["weights"].combine_chunks(),
        fitted["bias"].to_pylist(), strict=True)}
    machines = [Machine(first, second, found[i][0].values.to_numpy(), found[i][1])
                for i, (first, _, second, _) in enumerate(sides)]
    within: dict[str, list[Machine]] = {family: [] for family in families}
    for machine in machines[between:]:
        within[family_of(machine.first)].append(machine)
    return Model(families, machines[:between], within)


def _margins(texts: list[str], machines: list[Machine]) -> tuple[np.ndarray, np.ndarray]:
    """For each text the mean weight under each machine, and whether it has a letter."""
    sums = np.zeros((len(texts), len(machines)))
    counts = np.zeros(len(texts))
    lettered = np.zeros(len(texts), bool)

    def add(points: np.ndarray, owners: np.ndarray, starts: np.ndarray) -> None:
        """Points of several texts in a row; n-grams across a text's end are left out."""
        ends = np.append(starts[1:], len(points))
        for order, slots in zip(ORDERS, _slots(points), strict=True):
            inside = np.zeros(len(points), bool)
            inside[:len(slots)] = True
            for back in range(1, order):
                inside[ends - back] = False
            n = np.add.reduceat(inside, starts, dtype=np.int64)
            counts[owners] += n
            for k, m in enumerate(machines):
                weights = np.zeros(len(points), np.float32)
                weights[:len(slots)] = m.weights[slots]
                weights *= inside
                sums[owners, k] += np.add.reduceat(weights, starts, dtype=np.float64)

    waiting: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if waiting:
            sizes = np.array([len(points) for _, points in waiting])
            add(np.concatenate([points for _, points in waiting]),
                np.array([owner for owner, _ in waiting]), np.cumsum(sizes) - sizes)
            waiting.clear()

    held = 0
    for row, text in enumerate(texts):
        points = _points(text)
        lettered[row] = (points != 32).any()
        if not lettered[row]:
            continue
        if len(points) > PIECE:
            for slots in _slots_by_piece(points):
                counts[row] += len(slots)
                for k, m in enumerate(machines):
                    sums[row, k] += m.weights[slots].sum(dtype=np.float64)
            continue
        if held + len(points) > PIECE:
            flush()
            held = 0
        waiting.append((row, points))
        held += len(points)
    flush()
    return sums / np.maximum(counts, 1)[:, None], lettered


def _winner(names: list[str], machines: list[Machine], margins: dict[tuple[str, str], float]):
    """The name with most one-versus-one wins, then the largest margin; and its confidence."""
    if len(names) == 1:
        return names[0], 1.0
    wins = {name: [0, 0.0] for name in names}
    for m in machines:
        margin = margins[m.first, m.second]
        for name, own in ((m.first, -margin), (m.second, margin)):
            wins[name][0] += own > 0
            wins[name][1] += own
    best = max(names, key=lambda name: (*wins[name], name))
    least = min(margins[m.first, m.second] * (1 if m.second == best else -1)
                for m in machines if best in (m.first, m.second))
    return best, float(1 / (1 + np.exp(-min(max(2 * least, -30.0), 30.0))))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and family of every text.

    `docs` has doc_id and text; only text decides, and other columns are not read, whatever
    their names. One row for each input row, repeats included. A null or empty text, or one
    without a letter, is `und` with score 0, and so is every text if nothing was learnt. An
    empty table gives an empty result. Every n-gram of a text counts, however long it is.
    """
    # 64 KB for each machine: broadcast, so that it is sent to an executor once
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = list(model.families)

    def label(margins: np.ndarray, lettered: bool) -> tuple[str, float, str | None]:
        model = sent.value
        if not lettered or not names:
            return UNKNOWN, 0.0, None
        found = {(m.first, m.second): margin + m.bias
                 for m, margin in zip(model.machines(), margins, strict=True)}
        family, sure = _winner(names, model.between, found)
        lang, surer = _winner(model.families[family], model.within[family], found)
        return lang, min(max(sure * surer, 0.0), 1.0), family

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            margins, lettered = _margins(texts_of(batch), sent.value.machines())
            rows = [label(m, known) for m, known in zip(margins, lettered, strict=True)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "lang_pred": pa.array([lang for lang, _, _ in rows], pa.string()),
                "score": pa.array([score for _, score, _ in rows], pa.float64()),
                "family": pa.array([family for _, _, family in rows], pa.string())})

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double, family string")


def predict_held_out(docs: DataFrame) -> DataFrame:
    """Predictions for all documents by a model learnt outside the held-out quarter."""
    known = docs.select("doc_id", "text", "lang")
    model = learn(training_sample(known, bucket_of("doc_id", 4) != 2))
    found = predict(docs, model)
    return found.select("doc_id", (bucket_of("doc_id", 4) == 2).alias("held_out"),
                        "lang_pred", "score", "family")
