"""Column expressions for composite keys, normalised index keys and coerced values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def composite_key(prefix: str, value: Column | str) -> Column:
    """``PREFIX#value``; NULL when the value is NULL, so a sparse index stays sparse."""
    return F.concat(F.lit(f"{prefix}#"), _col(value).cast("string"))


def index_key(text: Column | str, prefix: str | None = None) -> Column:
    """Upper-cased text as a sort key, with an optional ``PREFIX#``. NULL text counts as empty."""
    upper = F.upper(F.coalesce(_col(text), F.lit("")))
    return upper if prefix is None else F.concat(F.lit(f"{prefix}#"), upper)


def search_key(text: Column | str) -> Column:
    return index_key(text, "SEARCH")


def is_linked(link: Column | str) -> Column:
    """An optional link counts only when it is neither NULL nor zero."""
    link = _col(link)
    return link.isNotNull() & (link != F.lit(0))


def number(value: Column | str, default: float = 0.0) -> Column:
    """Double, with the default for NULL. Unreadable text is an error under ANSI mode."""
    return F.coalesce(_col(value).cast("double"), F.lit(default))


def try_number(value: Column | str) -> Column:
    """Double, or NULL for text that is no number: for callers that set bad rows aside."""
    return _col(value).try_cast("double")


def full_name(first: Column | str, last: Column | str) -> Column:
    """Both parts joined by a blank, outer white space removed; a missing part adds nothing."""
    joined = F.concat(F.coalesce(_col(first), F.lit("")), F.lit(" "), F.coalesce(_col(last), F.lit("")))
    return F.regexp_replace(joined, r"^\s+|\s+$", "")
