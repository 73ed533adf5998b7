"""Quality rules as a ledger of bits.

Every rule is evaluated once per text. The ledger keeps the measurements and one integer whose bit N says that the rule
with bit N failed. A policy is a versioned mask over the bits: a text is rejected if it fails a rule of the mask. So a
policy is changed, compared or rolled back without reading a text again, and an ablation is arithmetic on bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.llm.common import each_text, sums, text_blocks, without

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutters", "n_upper", "n_letters")
MEASURED = T.StructType([T.StructField(m, T.LongType(), False) for m in MEASURES])

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[ord("A") : ord("Z") + 1] = True
LETTER = UPPER | np.roll(UPPER, 32)
# The first byte of a character outside ASCII counts as a letter.
LETTER[0xC0:] = True


@dataclass(frozen=True)
class Rule:
    """fails: a condition on the measurements; bit: its place in the ledger, never reused for another rule."""

    bit: int
    name: str
    fails: Callable[[Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Iterable["Rule"]) -> int:
        known = {r.name: 1 << r.bit for r in rules}
        return sum(known[name] for name in self.rules)


RULES = (
    Rule(0, "few_words", lambda m: m("n_words") < 20),
    Rule(1, "repeated_words", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
    Rule(2, "many_symbols", lambda m: 10 * m("n_symbols") > 3 * m("n_words")),
    Rule(3, "repeated_lines", lambda m: 2 * m("n_dup_lines") > m("n_lines")),
    Rule(4, "short_words", lambda m: m("word_chars") < 2 * m("n_words")),
    Rule(5, "long_words", lambda m: m("word_chars") > 20 * m("n_words")),
    Rule(6, "shouting", lambda m: 2 * m("n_upper") > m("n_letters")),
    Rule(7, "few_letters", lambda m: 2 * m("n_letters") < m("word_chars")),
    Rule(8, "stutters", lambda m: 2 * m("n_stutters") > m("n_words")),
)
BASE = Policy("base", ("few_words", "repeated_words"))
STANDARD = Policy("2", tuple(r.name for r in RULES))


def repetitions(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text in a window of WINDOW words found twice or more in it, and words equal to the one before.

    Windows are compared exactly: numbers of words are paired to numbers of 2, 4 and 8 words.
    """
    counts = np.array([len(w) for w in words], np.int64)
    text_of = np.repeat(np.arange(len(words)), counts)
    number = pd.factorize(np.array([x for own in words for x in own] or [b""], object))[0].astype(np.int64)[: len(text_of)]
    again = (number[1:] == number[:-1]) & (text_of[1:] == text_of[:-1])
    stutters = np.bincount(text_of[1:][again], minlength=len(words))
    if len(number) < WINDOW:
        return np.zeros(len(words), np.int64), stutters
    reach = 1
    while reach < WINDOW:
        pairs = number[:-reach] * (int(number.max()) + 1) + number[reach:]
        number = pd.factorize(pairs)[0].astype(np.int64)
        reach *= 2
    inside = text_of[: len(number)] == text_of[WINDOW - 1 :]
    code, _ = pd.factorize(text_of[: len(number)][inside] * (int(number.max()) + 1) + number[inside])
    often = np.bincount(code)[code] > 1
    at = np.flatnonzero(inside)[often]
    marked = np.zeros(len(text_of) + 1, np.int64)
    marked[at] += 1
    marked[at + WINDOW] -= 1
    covered = np.cumsum(marked)[:-1] > 0
    return np.bincount(text_of[covered], minlength=len(words)), stutters


def measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """MEASURES of each text."""
    texts = each_text(data, offsets)
    words = [t.split() for t in texts]
    lines = [[x for x in t.split(b"\n") if x and not x.isspace()] for t in texts]
    repeated, stutters = repetitions(words)
    visible = ((data & 0xC0) != 0x80) & ~BLANK[data]
    return [
        np.array([len(w) for w in words], np.int64),
        sums(visible, offsets),
        sums(SYMBOL[data], offsets),
        np.array([len(x) for x in lines], np.int64),
        np.array([len(x) - len(set(x)) for x in lines], np.int64),
        repeated,
        stutters,
        sums(UPPER[data], offsets),
        sums(LETTER[data], offsets),
    ]


@F.arrow_udf(MEASURED)
def measurements(texts: pa.Array) -> pa.Array:
    parts = [measure(*block) for block in text_blocks(texts)]
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64)] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(MEASURES))


def with_ledger(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The table with `measured` (a struct) and `failed` (bits, long). Columns of these names are replaced.

    Null and empty texts measure zero everywhere, so they fail `few_words` only. Texts are read whole. Equal rows stay
    separate and get equal values.
    """
    df = without(df, "measured", "failed")
    df = df.withColumn("measured", measurements(F.coalesce(df[f"`{text}`"], F.lit(""))))
    bits = F.lit(0).cast("long")
    for rule in rules:
        failed = rule.fails(lambda name: F.col("measured")[name])
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << rule.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return df.withColumn("failed", bits)


def kept(policy: Policy = STANDARD, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a row of the ledger passes every rule of the policy."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def only_rule(policy: Policy = STANDARD, rules: tuple[Rule, ...] = RULES) -> Column:
    """The name of the one rule of the policy that a row of the ledger fails; null for none or several."""
    bits = F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("long"))
    name = F.lit(None).cast("string")
    for rule in rules:
        name = F.when(bits == 1 << rule.bit, rule.name).otherwise(name)
    return name


def save_ledger(ledger: DataFrame, path: str) -> None:
    """Store the ledger without the texts; one that is there already is an error."""
    ledger.drop("text").write.mode("errorifexists").parquet(path)


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ablations(ledger: DataFrame, policy: Policy = STANDARD, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of the policy: texts that fail it, that fail nothing else, and that the policy keeps without it.

    One pass over the bits, summed per distinct value of `failed` before anything is compared.
    """
    mask = policy.mask(rules)
    seen = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("failed")).agg(F.count("*").alias("n"))
    per_rule = [r for r in rules if r.name in policy.rules]
    options = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in per_rule])
    each = seen.select("failed", "n", F.explode(options).alias("of")).select("failed", "n", "of.rule", "of.bit")
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    rest = F.col("failed").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0
    count = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0)).alias
    return (
        each.groupBy("rule")
        .agg(count(fails)("n_failed"), count(fails & rest)("n_only"), count(rest)("n_kept_without"))
        .withColumn("policy", F.lit(policy.version))
    )
