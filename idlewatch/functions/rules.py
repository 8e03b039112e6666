"""Ordered lookup rules as SQL expressions over built-in functions."""

from __future__ import annotations

from collections.abc import Iterable

from idlewatch.functions import fixed_values as fixed
from idlewatch.functions.sql import any_of, first_match, text, text_list, text_map


def contains(column: str, fragment: str) -> str:
    return f"contains({column}, {text(fragment)})"


def missing_or_zero(value: str) -> str:
    """True where a stored factor or amount has to be derived instead."""
    return f"({value} IS NULL OR {value} = 0)"


def _sized(usage_type: str, otherwise: str) -> str:
    return first_match(
        ((contains(usage_type, size), f"{factor}D") for size, factor in fixed.SIZE_FACTORS),
        otherwise,
    )


def size_factor(usage_type: str, stored: str) -> str:
    """Normalisation factor by size; the stored factor where no size is recognised."""
    return _sized(usage_type, stored)


def size_factor_zoned(usage_type: str, stored: str) -> str:
    """Size factor for databases: doubled for multi-zone deployments.

    A recognised size without a zone marker keeps the stored factor, like an unknown
    size: without a marker no other size could match either.
    """
    single = any_of(contains(usage_type, m) for m in fixed.SINGLE_ZONE_MARKERS)
    multi = any_of(contains(usage_type, m) for m in fixed.MULTI_ZONE_MARKERS)
    zones = first_match([(single, "1D"), (multi, f"{fixed.MULTI_ZONE_WEIGHT}D")])
    return f"coalesce({_sized(usage_type, 'NULL')} * {zones}, {stored})"


def os_label(operation: str) -> str:
    prefix = fixed.COMPUTE_OPERATION
    coded = [
        (f"startswith({operation}, {text(f'{prefix}:{code}')})", text(label))
        for code, label in fixed.COMPUTE_CODES
    ]
    plain = (f"{operation} = {text(prefix)}", text(fixed.COMPUTE_PLAIN_LABEL))
    return first_match([plain, *coded], "''")


def _code_label(operation: str, prefix: str, codes: Iterable[tuple[str, str]]) -> str:
    return f"try_element_at({text_map((f'{prefix}:{c}', label) for c, label in codes)}, {operation})"


def engine_label(operation: str) -> str:
    label = _code_label(operation, fixed.DATABASE_OPERATION, fixed.DATABASE_CODES)
    return f"coalesce({label}, '')"


def cache_engine_label(operation: str) -> str:
    """NULL for an unknown operation, unlike the other label rules."""
    return _code_label(operation, fixed.CACHE_OPERATION, fixed.CACHE_CODES)


def is_accelerator(family: str) -> str:
    # One pattern: a chain of tests, repeated per unit, made code too long to be compiled by the JVM.
    return f"lower({family}) RLIKE {text('|'.join(fixed.ACCELERATOR_FAMILIES))}"


def shares_family(engine: str, open_names: Iterable[str]) -> str:
    """Own-licence and open engines share a reservation over all sizes of a family."""
    return f"({contains(engine, fixed.BYOL_MARKER)} OR {engine} IN {text_list(open_names)})"


def family_label(instance_type: str, engine: str, open_names: Iterable[str], part: int) -> str:
    """Family for shared reservations, the full instance type for all others."""
    return first_match(
        [
            (is_accelerator(instance_type), instance_type),
            (shares_family(engine, open_names), f"split_part({instance_type}, '.', {part})"),
        ],
        instance_type,
    )


def region_label(region_code: str, usage_type: str) -> str:
    return first_match(
        (
            (
                f"startswith({region_code}, {text(code)}) OR {contains(usage_type, f'{prefix}-')}",
                text(place),
            )
            for code, prefix, place in fixed.REGIONS
        ),
        "''",
    )
