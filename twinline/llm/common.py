"""Small shared helpers: row identity, text sizes, case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.shared import checkpoint_dir, clear, discard, mark, materialize

__all__ = ["NULL_ID", "ascii_lower", "checkpoint_dir", "clear", "discard", "id_key", "mark", "materialize", "n_words", "text_of"]

#: Stands for a null doc_id, so that null sorts before every other id.
NULL_ID = -(2**63)


def id_key(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def n_words(col: Column) -> Column:
    """Number of runs of anything but the six ASCII blanks; 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z and nothing else; pure ASCII takes the cheap way."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(F.translate(col, upper, lower))
