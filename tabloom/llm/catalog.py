"""All registered queries of this package."""

from __future__ import annotations

from tabloom.llm import (
    byte_bpe,
    decontaminate,
    filter_audit,
    hard_negatives,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    quality_classifier,
    quality_rules,
    substring_dedup,
    token_counts,
    url_filter,
)
from tabloom.plans.catalog import Query


def llm_queries() -> dict[str, Query]:
    modules = (
        licenses,
        quality_classifier,
        decontaminate,
        token_counts,
        quality_rules,
        substring_dedup,
        mixing,
        url_filter,
        line_dedup,
        near_dedup,
        byte_bpe,
        filter_audit,
        hard_negatives,
    )
    merged: dict[str, Query] = {}
    for module in modules:
        merged.update(module.CATALOG)
    return merged
