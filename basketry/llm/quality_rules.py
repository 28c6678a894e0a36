"""Quality rules as a ledger of failure bits.

Every rule is judged once per document; the ledger keeps the measurements and one bit per failed rule. A policy is a
set of rules, that is a mask: applying another version, or asking what a rule adds, never reads a text again.
Rules compare whole numbers, so that any engine gives the same bits.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import each_piece, texts_of
from basketry.llm.text_stats import COUNTS, counts

#: Name and failure condition (SQL over the measurements). The position is the bit; append only.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("capitals", "2 * n_upper > n_letters"),
    ("exclamation_marks", "2 * n_marks > n_words"),
    ("long_words", "word_chars > 15 * n_words"),
)
#: Versions of the policy: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(name for name, _ in RULES),
}


def mask_of(rules: Iterable[str]) -> int:
    bits = {name: 1 << k for k, (name, _) in enumerate(RULES)}
    return sum(bits[name] for name in set(rules))


def ledger(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, the measurements and ``failed`` (long), one row per document.

    A null text is empty: all counts are zero and only ``few_words`` fails. Equal rows give equal rows; a null id stays
    null; other columns are left out, whatever their names; an empty table gives an empty ledger.
    """

    def measure(piece):
        return {"doc_id": piece.column("doc_id"), **counts(piece.column("text"))}

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    measured = each_piece(texts_of(documents, id_column, text_column), measure, schema)
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, rule) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed)


def fails(policy: str) -> Column:
    """Whether a row of the ledger fails the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) != 0


def verdicts(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a version of the policy."""
    return rows.withColumns({"base_failed": fails("base"), "kept": ~(fails("base") | fails(policy))})


def ablations(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of the policy: documents that fail it, and documents that only it rejects.

    The ledger first shrinks to one row per combination of bits, so no text or document takes part.
    """
    mask = mask_of(POLICIES[policy])
    combos = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    per_rule = [
        F.struct(
            F.lit(name).alias("rule"),
            F.when(F.col("bits").bitwiseAND(F.lit(1 << k)) != 0, F.col("n")).otherwise(0).alias("n_failed"),
            F.when(F.col("bits") == (1 << k), F.col("n")).otherwise(0).alias("n_only"),
        )
        for k, (name, _) in enumerate(RULES)
        if name in POLICIES[policy]
    ]
    return (
        combos.select(F.explode(F.array(*per_rule)).alias("r")).select("r.*")
        .groupBy("rule").agg(F.sum("n_failed").alias("n_failed"), F.sum("n_only").alias("n_only"))
    )
