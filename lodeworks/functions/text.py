"""Text normalisation expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The spellings of "no value" found in the raw feeds. The match is
# exact and case-sensitive, so "null" and " NULL " are ordinary text.
NULL_TOKENS = ("nul", "NULL", "NA", "")


def null_if_token(column: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """NULL where the text is one of the tokens, unchanged otherwise."""
    return F.when(~column.isin(*tokens), column)


def joined_name(*columns: Column) -> Column:
    """Parts separated by one space; NULL parts are skipped."""
    return F.concat_ws(" ", *columns)
