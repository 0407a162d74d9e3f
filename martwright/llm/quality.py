"""Rule bitmask ledger: every rule is evaluated once, policies are applied to the stored bits later.

``ledger`` keeps the measurements of a document and one bit for each rule it fails. A policy is a
mask over these bits, so a new policy, or the question what a rule alone costs, needs no text:
``apply_policy`` and ``ablations`` work on the ledger. Built-in functions only.

Defined results: a NULL or empty text has no words, all measurements 0, and fails the rule on too
few words. Repeated rows and NULL ids are judged each for itself. Extra columns are not read. An
empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.text import WORD, words_of

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


@dataclass(frozen=True)
class Rule:
    """``fails`` gets the measurements by name; the bit never changes once ledgers are stored."""

    name: str
    bit: int
    fails: Callable[[Callable[[str], Column]], Column]


RULES = [
    Rule("too_few_words", 0, lambda m: m("n_words") < 50),
    Rule("repeated_windows", 1, lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
    Rule("symbols", 2, lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("duplicate_lines", 3, lambda m: 2 * m("n_dup_lines") > m("n_lines")),
    Rule("short_words", 4, lambda m: m("word_chars") < 3 * m("n_words")),
    Rule("long_words", 5, lambda m: m("word_chars") > 12 * m("n_words")),
]

# The rules of each policy version; a version is never edited, a change gets a new name.
POLICIES = {
    "base": ["too_few_words", "repeated_windows"],
    "v1": ["too_few_words", "repeated_windows", "symbols", "duplicate_lines", "short_words", "long_words"],
}


def mask_of(names: list[str], rules: list[Rule] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[n] for n in set(names))


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more in the text, the first find included.

    The windows carry their place and are sorted, so equal ones are neighbours. Texts without
    any repeat, the usual case, are settled by a distinct count and never sorted. (The last two
    "windows" have two words and one; each differs from every other window.)
    """
    windows = F.transform(words, lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)))

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return F.transform(F.array(placed), hits_of)[0]

    def hits_of(placed: Column) -> Column:
        same = F.filter(
            placed,
            lambda x, j: (F.get(placed, j - 1)["w"] == x["w"]) | (F.get(placed, j + 1)["w"] == x["w"]),
        )
        places = F.flatten(F.transform(same, lambda x: F.sequence(x["i"], x["i"] + 2)))
        return F.size(F.array_distinct(places))

    # transform over a one-element array evaluates its element once for all uses of it
    once = F.transform(
        F.array(windows),
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)),
    )
    return once[0].cast("long")


def measured(text: Column) -> Column:
    """A struct of the measurements, all long.

    ``word_chars``: code points in words. ``n_symbols``: characters of ``#*$%&|<>``. ``n_lines``:
    \\n-split lines with a word. ``n_dup_lines``: those equal to an earlier line.
    """
    filled = F.coalesce(text, F.lit(""))

    def fields(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(filled, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
        )

    lines = F.filter(F.split(filled, "\n"), lambda x: x.rlike(WORD))
    parts = F.array(F.struct(words_of(text).alias("words"), lines.alias("lines")))
    return F.transform(parts, lambda p: fields(p["words"], p["lines"]))[0]


def failure_bits(measure: Callable[[str], Column], rules: list[Rule] = RULES) -> Column:
    """One long: bit k is set if the rule with bit k fails."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.fails(measure), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """One row per document: ``doc_id``, the measurements and ``failed_bits``."""
    m = docs.select("doc_id", measured(F.col("text")).alias("m")).select("doc_id", "m.*")
    return m.withColumn("failed_bits", failure_bits(F.col, rules))


def passes(bits: Column, policy: str) -> Column:
    return bits.bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0


def apply_policy(ledger: DataFrame, policy: str) -> DataFrame:
    """The ledger with ``kept``, the verdict of one policy version."""
    return ledger.withColumn("kept", passes(F.col("failed_bits"), policy))


def ablations(ledger: DataFrame, policy: str, rules: list[Rule] = RULES) -> DataFrame:
    """What each rule of a policy does: documents that fail it, that fail it alone (so dropping the
    rule would bring them back), and that it fails together with others.

    Equal bit patterns are counted first, so what is shuffled is at most one row per pattern and task.
    """
    mask = mask_of(POLICIES[policy], rules)
    patterns = ledger.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(
        F.count("*").alias("n")
    )
    wanted = [r for r in rules if r.name in POLICIES[policy]]
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in wanted]))
    rows = patterns.select("bits", "n", each.alias("r")).select("bits", "n", "r.*")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))
    return rows.groupBy("rule").agg(
        total(hit).alias("failed"),
        total(F.col("bits") == F.col("bit")).alias("failed_alone"),
        total(hit & (F.col("bits") != F.col("bit"))).alias("failed_with_others"),
    )


def keep_good(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The documents that a policy keeps, with all their columns."""
    row = F.struct(*[docs[c] for c in docs.columns])
    judged = docs.select(row.alias("row"), measured(F.col("text")).alias("m"))
    bits = failure_bits(lambda name: F.col("m")[name])
    return judged.filter(passes(bits, policy)).select("row.*")
