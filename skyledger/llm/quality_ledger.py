"""Quality rules as a ledger: every rule is measured once and leaves one failure bit.

A policy is a named, versioned mask of rules; it is applied to the bits and never reads the
text again. What each rule removes under a policy follows from the counts of distinct masks.
Only built-in expressions are used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MEASUREMENTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
                "n_letters", "n_capitals", "n_exclamations"]


@dataclass(frozen=True)
class Rule:
    """A bit and the SQL condition, over the measurements, under which a text fails."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 35 * n_lines"),
    Rule(4, "capitals", "100 * n_capitals > 40 * n_letters"),
    Rule(5, "exclamations", "10 * n_exclamations > n_words"),
    Rule(6, "word_length", "word_chars < 3 * n_words or word_chars > 10 * n_words"),
    Rule(7, "few_letters", "100 * n_letters < 60 * word_chars"),
)
BASE = ("few_words", "repeated_words")
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines", "word_length"),
    "v2": tuple(rule.name for rule in RULES),
}
CURRENT = "v2"


def mask_of(names: tuple[str, ...] | list[str]) -> int:
    bits = {rule.name: 1 << rule.bit for rule in RULES}
    return sum(bits[name] for name in set(names))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(words: Column) -> Column:
    """Words inside a window of three that occurs twice or more.

    Windows are compared as 64-bit hashes within one text. Sorted with their positions, equal
    ones stand side by side; each repeated window adds the words up to the next repeated one.
    """
    last = F.size(words) - 3
    hashes = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def positions(windows: Column) -> Column:
        placed = F.sort_array(F.transform(
            windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = _let(placed, lambda s: F.filter(s, lambda x, k: (
            x["h"].eqNullSafe(F.get(s, k - 1)["h"]) | x["h"].eqNullSafe(F.get(s, k + 1)["h"]))))
        return F.sort_array(F.transform(repeated, lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda start, k: F.least(
            F.lit(3), F.coalesce(F.get(starts, k + 1) - start, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    found = _let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(positions(h), covered)))
    return F.when(last < 1, F.lit(0)).otherwise(found)


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _measured(text: Column) -> Column:
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.transform(
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        lambda line: F.xxhash64(line))
    of_words = _let(words, lambda w: F.struct(
        F.size(w).alias("n"), _repeated(w).alias("repeated")))
    of_lines = _let(lines, lambda x: F.struct(
        F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")))
    counts = {
        "word_chars": F.length(F.translate(text, SPACES, "")),
        "n_symbols": _without(text, SYMBOLS),
        "n_letters": F.length(F.regexp_replace(text, r"\P{L}+", "")),
        "n_capitals": F.length(F.regexp_replace(text, r"\P{Lu}+", "")),
        "n_exclamations": _without(text, "!"),
    }
    return F.struct(of_words.alias("words"), of_lines.alias("lines"),
                    *(value.alias(name) for name, value in counts.items()))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and fail_bits of every text.

    `docs` has doc_id and text; other columns are not read, whatever their names. One row for
    each input row, repeats included. A null or empty text has no words, lines or characters.
    An empty table gives an empty result. Each text is measured within its own row, in memory
    and time about in proportion to its length.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].alias("doc_id"), _measured(text).alias("m"))
    place = {"n_words": "m.words.n", "n_repeat_words": "m.words.repeated", "n_lines": "m.lines.n",
             "n_dup_lines": "m.lines.again"}
    measured = rows.select("doc_id", *(
        F.col(place.get(name, f"m.{name}")).cast("bigint").alias(name) for name in MEASUREMENTS))
    bits = [F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)) for rule in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("fail_bits", total.cast("bigint"))


def judge(found: DataFrame, policy: str = CURRENT) -> DataFrame:
    """A ledger with base_failed and, by the named policy, kept."""
    def fails(names) -> Column:
        return F.col("fail_bits").bitwiseAND(F.lit(mask_of(names)).cast("bigint")) != 0

    return found.withColumn("base_failed", fails(BASE)).withColumn(
        "kept", ~F.col("base_failed") & ~fails(POLICIES[policy]))


def verdicts(found: DataFrame) -> DataFrame:
    """A ledger with kept_<policy> for every policy and, under the current one, only_rule.

    only_rule is the one rule that removes the text: without it the text would be kept. It is null
    where no rule or several ones do.
    """
    def hit(policy: str) -> Column:
        return F.col("fail_bits").bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("bigint"))

    alone = F.coalesce(*(
        F.when(hit(CURRENT) == mask_of([rule.name]), rule.name) for rule in RULES))
    return found.select("*", *((hit(policy) == 0).alias(f"kept_{policy}") for policy in POLICIES),
                        alone.alias("only_rule"))


def ablations(found: DataFrame) -> DataFrame:
    """For each policy and each of its rules: what the rule fails, alone or with others.

    policy, rule, kept (texts kept under the policy), failed (by the rule), only (removed by this rule and
    no other of the policy, so kept without it). Computed from one row for each distinct mask,
    of which there are at most two to the number of rules.
    """
    spark = found.sparkSession
    masks = found.groupBy("fail_bits").agg(F.count("*").alias("n"))
    cases = [(policy, mask_of(names), rule.name, 1 << rule.bit)
             for policy, names in POLICIES.items() for rule in RULES if rule.name in names]
    table = spark.createDataFrame(cases, "policy string, mask bigint, rule string, bit bigint")
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    rows = masks.select("fail_bits", "n", F.explode(F.array(*(
        F.struct(F.lit(p).alias("policy"), F.lit(m).cast("bigint").alias("mask"),
                 F.lit(r).alias("rule"), F.lit(b).cast("bigint").alias("bit"))
        for p, m, r, b in cases))).alias("c")).select("fail_bits", "n", "c.*")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    counted = rows.groupBy("policy", "rule").agg(
        total(hit == 0).alias("kept"), total(hit.bitwiseAND(F.col("bit")) != 0).alias("failed"),
        total(hit == F.col("bit")).alias("only"))
    return (table.select("policy", "rule").join(counted, ["policy", "rule"], "left")
            .na.fill(0, ["kept", "failed", "only"]))


_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, p, words[p] AS a, words[p + 1] AS b, words[p + 2] AS c, len(words) AS n
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM (
    SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM t))),
r AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times FROM w WHERE p + 2 <= n)
  WHERE times > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM r) GROUP BY doc_id),
l AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc_id,
    CAST(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(length(regexp_replace(text, '\P{L}+', '', 'g')) AS BIGINT) AS n_letters,
    CAST(length(regexp_replace(text, '\P{Lu}+', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_exclamations
  FROM t LEFT JOIN l USING (doc_id) LEFT JOIN repeated USING (doc_id)),
f AS (SELECT *, CAST({bits} AS BIGINT) AS fail_bits FROM m)
{result}
"""
_BITS = " + ".join(f"CASE WHEN {rule.fails} THEN {1 << rule.bit} ELSE 0 END" for rule in RULES)
_VERDICTS = ", ".join(f"fail_bits & {mask_of(names)} = 0 AS kept_{policy}"
                      for policy, names in POLICIES.items())
_CASES = ", ".join(
    f"('{policy}', {mask_of(names)}, '{rule.name}', {1 << rule.bit})"
    for policy, names in POLICIES.items() for rule in RULES if rule.name in names)
_ONLY = " ".join(f"WHEN {1 << rule.bit} THEN '{rule.name}'" for rule in RULES)


def _sql(result: str) -> str:
    return _SQL.replace("{bits}", _BITS).replace("{result}", result)


ORACLE_SQL = _sql(f"""SELECT *, fail_bits & {mask_of(BASE)} <> 0 AS base_failed,
  fail_bits & {mask_of(POLICIES[CURRENT])} = 0 AS kept, {_VERDICTS},
  CASE fail_bits & {mask_of(POLICIES[CURRENT])} {_ONLY} END AS only_rule FROM f""")
ABLATIONS_SQL = _sql(f"""SELECT policy, "rule", CAST(count_if(fail_bits & mask = 0) AS BIGINT) AS kept,
  CAST(count_if(fail_bits & bit <> 0) AS BIGINT) AS failed,
  CAST(count_if(fail_bits & mask = bit) AS BIGINT) AS "only"
FROM f, (VALUES {_CASES}) AS c(policy, mask, "rule", bit) GROUP BY policy, "rule"
""")
