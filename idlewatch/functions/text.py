"""Locations and file names, as SQL expressions."""

from __future__ import annotations

# Blank, tab, line feed, carriage return, vertical tab, form feed.
BLANKS = "' \\t\\n\\r' || char(11) || char(12)"


def _without_scheme(location: str) -> str:
    return f"regexp_replace({location}, '^s3://', '')"


def bucket_of(location: str) -> str:
    """``s3://bucket/path`` -> bucket; the scheme is optional."""
    return f"trim(BOTH {BLANKS} FROM split_part({_without_scheme(location)}, '/', 1))"


def path_of(location: str) -> str:
    """Everything after the first ``/`` of the location, '' if there is none."""
    rest = f"regexp_extract({_without_scheme(location)}, '(?s)^[^/]*/(.*)$', 1)"
    return f"trim(BOTH {BLANKS} FROM {rest})"


def base_name(key: str) -> str:
    return f"element_at(split({key}, '/'), -1)"


def environment_bucket(bucket: str, environment: str) -> str:
    """Production reads the bucket without its ``-nonprod`` marker."""
    if environment.lower() != "prod":
        return bucket
    return f"replace({bucket}, '-nonprod', '')"
