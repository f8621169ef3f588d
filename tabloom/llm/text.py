"""Column expressions shared by the operators. Words are runs of anything but ASCII white space."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Most bytes of texts that travel to a Python worker at once.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Let batches for Python workers end by bytes as well as by rows, so long texts do not add up.

    Sets the session's limit, unless it is lower already.
    """
    digits = re.fullmatch(r"(\d+)b?", spark.conf.get(_BATCH_SETTING))
    if not digits or not 0 < int(digits[1]) <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: Column) -> Column:
    """The text, a missing one as the empty text."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Words in order; none for a missing or blank text."""
    trimmed = F.btrim(whole(text), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_RUN))


def word_count(text: Column) -> Column:
    trimmed = F.btrim(whole(text), F.lit(WHITE))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WHITE_RUN))).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def unit_hash(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the keys only; missing keys are a value."""
    parts = [F.coalesce(k.cast("string"), F.lit("null")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))
