"""JSON objects out of a model's answer, as VARIANT: the whole text, else its outermost braces, else without fences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def extract_json(text: Column) -> Column:
    text = strip(text)
    braces = F.regexp_extract(text, r"\{[\s\S]*\}", 0)
    bare = strip(F.regexp_replace(text, "```(?:json)?", ""))
    return F.coalesce(
        F.try_parse_json(text), F.try_parse_json(F.when(braces != "", braces)), F.try_parse_json(bare)
    )
