"""Quality rules as a bitmask ledger, with DataFrame functions only.

``measure`` evaluates the measurements of every text once; ``ledger`` turns each rule into
one failure bit; ``apply_policy`` keeps or rejects by a versioned policy (a mask of rules);
``ablation`` tells, from the bits alone, what each rule rejects and what it rejects alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import WORD_RE, WS, text_of

WINDOW = 5
#: rule name -> SQL condition of failure over the measurements; the order gives the bits
RULES: dict[str, str] = {
    "too_few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "n_lines >= 4 and 10 * n_dup_lines > 6 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 14 * n_words)",
    "shouting": "n_upper >= 40 and 2 * n_upper > n_letters",
}


@dataclass(frozen=True)
class Policy:
    """A named, versioned set of rules; a text fails if any of them fails."""
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << i for i, r in enumerate(RULES) if r in self.rules)


#: The two base rules of the contract, and the method's verdict on top of them.
BASE = Policy("base-1", ("too_few_words", "repeated_words"))
CURRENT = Policy("2", tuple(RULES))


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, measurements...) of every text, NULL as empty (all measurements 0).

    n_words, word_chars (code points in words), n_symbols (``#*$%&|<>``), n_lines
    (lines with a word), n_dup_lines (those equal to an earlier line), n_upper and
    n_letters (ASCII), n_repeat_words (words covered by a 5-word window found at least
    twice in the text). Everything is per row: no shuffle, and repeated rows, ties and
    very long texts need no special care. Windows are compared by their 64-bit hash
    inside one text.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    base = base.select(
        "doc_id",
        (F.length("t") - F.regexp_count("t", F.lit(f"[{WS}]"))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("t", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("t", F.lit("[A-Za-z]")).cast("long").alias("n_letters"),
        F.filter(F.split("t", "\n", -1), lambda x: x.rlike(f"[^{WS}]")).alias("lines"),
        F.regexp_extract_all("t", F.lit(f"({WORD_RE})"), F.lit(1)).alias("w"))
    hashed = base.select(
        "doc_id", "word_chars", "n_symbols", "n_upper", "n_letters",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("w").cast("long").alias("n_words"),
        F.when(F.size("w") >= WINDOW, F.expr(
            f"transform(sequence(0, size(w) - {WINDOW}), i -> xxhash64("
            + ", ".join(f"w[i + {j}]" for j in range(WINDOW)) + "))")).alias("h"))
    # only texts that have a repeated window sort their windows
    repeats = F.size("h") > F.size(F.array_distinct("h"))
    placed = hashed.withColumn("s", F.when(repeats, F.expr(
        "sort_array(transform(h, (x, i) -> struct(x as x, i as i)))")))
    # positions of windows that equal a neighbour in hash order, back in text order
    found = placed.withColumn("p", F.when(F.col("s").isNotNull(), F.expr(
        "array_sort(transform(filter(s, (e, k) -> "
        "(k > 0 and s[k - 1].x = e.x) or (k < size(s) - 1 and s[k + 1].x = e.x)), e -> e.i))")))
    covered = F.expr(
        f"aggregate(p, named_struct('last', -{WINDOW}, 'n', 0L), "
        f"(a, i) -> named_struct('last', i, 'n', a.n + least({WINDOW}, i - a.last)), a -> a.n)")
    measured = found.select("doc_id", F.struct(
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_upper", "n_letters",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).alias("m"))
    # the generator keeps later filters from being pushed below, which would copy the
    # measuring expressions into every condition and evaluate them many times
    return measured.select("doc_id", F.explode(F.array("m")).alias("m")).select("doc_id", "m.*")


def failure_bits() -> Column:
    bits = F.lit(0).cast("long")
    for i, cond in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, **cols) -> DataFrame:
    """The measurements of every text and ``failed_bits``, one bit per rule of ``RULES``."""
    return measure(docs, **cols).withColumn("failed_bits", failure_bits())


def passes(policy: Policy) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def apply_policy(led: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger with ``policy`` (its version) and ``kept``."""
    return led.withColumn("policy", F.lit(policy.version)).withColumn("kept", passes(policy))


def ablation(led: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """(rule, n_docs, n_failed, n_only): per rule of the policy, how many texts fail it, and
    how many the policy would keep without it. One pass over the ledger: the bits are
    first counted by value (at most 2^rules groups), then expanded.
    """
    mask = F.lit(policy.mask).cast("long")
    counted = (led.groupBy(F.col("failed_bits").bitwiseAND(mask).alias("bits"))
               .agg(F.count("*").alias("n")))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
                      for i, r in enumerate(RULES) if r in policy.rules])
    each = counted.select("bits", "n", F.explode(rules).alias("r"))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum("n").alias("n_docs"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0))
        .alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"))


def keep_passing(docs: DataFrame, policy: Policy = CURRENT, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass ``policy``, columns unchanged."""
    rows = docs.select(F.struct("*").alias("row"))
    led = ledger_of_rows(rows, text_col)
    return led.filter(passes(policy)).select("row.*")


def ledger_of_rows(rows: DataFrame, text_col: str) -> DataFrame:
    led = measure(rows.select("row", F.col(f"row.{text_col}").alias("text")), id_col="row",
                  text_col="text")
    return led.withColumnRenamed("doc_id", "row").withColumn("failed_bits", failure_bits())
