"""Text helpers: blank tests, dates, URLs and comma lists of tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.fixed_values import PRODUCT_URL_PREFIX, PRODUCT_URL_SUFFIX


def is_blank(text: Column) -> Column:
    """Null, empty or whitespace only."""
    return text.isNull() | text.rlike(r"^\s*$")


def compact_date(text: Column) -> Column:
    """`1992-05-31` as `19920531`."""
    return F.regexp_replace(text, "-", "")


def product_id(url: Column) -> Column:
    """Text from the first `/product/` to the first `.html`, null unless that comes later."""
    start = F.instr(url, PRODUCT_URL_PREFIX)
    end = F.instr(url, PRODUCT_URL_SUFFIX)
    first = start + len(PRODUCT_URL_PREFIX)
    found = (start > 0) & (end > start)
    return F.when(found, F.substr(url, first, end - first))


def id_list(structs: Column, field: str) -> Column:
    """One field of an array of structs as a comma list, in array order (F16)."""
    return F.array_join(F.transform(structs, lambda s: s[field].cast("string")), ",")


def tag_array(tags: Column) -> Column:
    """Comma list as an array; blank text and empty pieces give no element."""
    pieces = F.array_remove(F.split(tags, ","), "")
    return F.when(is_blank(tags), F.array().cast("array<string>")).otherwise(pieces)


def tag_list(tags: Column) -> Column:
    """Array of tags as a comma list in string order, null when empty."""
    return F.when(F.size(tags) > 0, F.array_join(F.sort_array(tags), ","))


def merge_tags(new: Column, old: Column) -> Column:
    """Union of two comma lists as a set, null when both are blank."""
    return tag_list(F.array_union(tag_array(new), tag_array(old)))
