"""Document keys.

A document is (cmpcode, doccode, docnum), compared without surrounding spaces.
The trimmed parts are computed once per row and carried as columns, so joins
hash and sort plain strings.  Tables stored by document bring them along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

RAW_KEY = ("cmpcode", "doccode", "docnum")
KEY = ("key_company", "key_code", "key_number")


def has_document_key(df: DataFrame) -> bool:
    """Whether a frame carries the normalised key already, as tables stored by document do."""
    return set(KEY) <= set(df.columns)


def with_document_key(df: DataFrame) -> DataFrame:
    if has_document_key(df):
        return df
    return df.withColumns({key: F.trim(raw) for key, raw in zip(KEY, RAW_KEY)})


def document_columns(df: DataFrame) -> list[str]:
    """What rows of a document are grouped by: the stored parts, after the normalised ones where these are
    stored, so that buckets of them serve the grouping and what follows.
    """
    return [*KEY, *RAW_KEY] if has_document_key(df) else [*RAW_KEY]


def company_of(df: DataFrame) -> Column:
    """The company without surrounding spaces; a stored column can be filtered in the scan."""
    return F.col(KEY[0]) if has_document_key(df) else F.trim(RAW_KEY[0])


def document_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join two frames that both carry the document key; the key appears once."""
    return left.join(right, list(KEY), how)
