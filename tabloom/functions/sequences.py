"""Fixed-length id sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reserved tokens and their ids.
SPECIAL_TOKENS = ("<PAD>", "<SOS>", "<EOS>")
PAD, SOS, EOS = 0, 1, 2


def pad_ids(ids: str | Column, length: int) -> Column:
    """Start mark, ids, end mark; cut at ``length`` (the end mark may go) or filled with PAD."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    marked = F.concat(F.array(F.lit(SOS)), ids, F.array(F.lit(EOS)))
    return F.slice(F.concat(marked, F.array_repeat(F.lit(PAD), length)), 1, length)


def decoder_input(ids: str | Column, length: int) -> Column:
    """All but the last id."""
    return F.slice(ids, 1, length - 1)


def decoder_target(ids: str | Column, length: int) -> Column:
    """All but the first id."""
    return F.slice(ids, 2, length - 1)


def pad_mask(ids: str | Column) -> Column:
    """True where the sequence holds PAD; an unknown word is PAD as well."""
    return F.transform(ids, lambda x: x == F.lit(PAD))
