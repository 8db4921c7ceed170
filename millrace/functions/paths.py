"""Paths: in statements, and which file a row came from, seen through a pattern with wildcards."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_text(value: str) -> str:
    """A text as a literal of a SQL statement."""
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def pattern_regex(pattern: str) -> str:
    """Regular expression with one group per ``*`` of a path pattern."""
    pieces = [re.escape(piece) for piece in pattern.split("*")]
    return "([^/]*)".join(pieces) + "$"


def filepath(pattern: str, wildcard: int) -> Column:
    """Text matched by the n-th ``*`` of the pattern, for the file of each row; NULL if it does not match.

    Reads the hidden ``_metadata`` column, so use it directly on a file scan.
    """
    # The column is URL-encoded, the pattern is not; decoding would turn a plus into a blank.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    regex = pattern_regex(pattern)
    return F.when(path.rlike(regex), F.regexp_extract(path, regex, wildcard))
