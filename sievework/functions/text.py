"""Text expressions with the domain's exact semantics (Unicode white space, code points, half-even rounding)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_USER = 80
CALL_PATTERN = r"(?s)<tool_call>\s*(.*?)\s*</tool_call>"
CALL_TYPE = "array<struct<name:string,arguments:map<string,string>>>"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends (``trim`` removes spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+$", "")


def falsy_coalesce(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def of_role(messages: Column, *roles: str) -> Column:
    return F.filter(messages, lambda m: m["role"].isin(*roles))


def first_user(messages: Column) -> Column:
    """Content of the first user message, else ''."""
    return F.coalesce(F.get(of_role(messages, "user"), 0)["content"], F.lit(""))


def last_assistant(messages: Column) -> Column:
    """Content of the last assistant message; null without one."""
    return F.try_element_at(of_role(messages, "assistant"), F.lit(-1))["content"]


def last_role(messages: Column) -> Column:
    return F.try_element_at(messages, F.lit(-1))["role"]


def joined(array: Column) -> Column:
    """A flat, comparable form of a list: sorted and joined by ``|``."""
    return F.array_join(F.sort_array(array), "|")


def strict_json(raw: Column, kind: str) -> Column:
    """``raw`` as exactly one JSON value of the given element type; null if it is anything else.

    Wrapping it in a list rejects trailing text, which the parser would let pass.
    """
    many = F.from_json(F.concat(F.lit("["), raw, F.lit("]")), f"array<{kind}>", {"allowSingleQuotes": "false"})
    return F.when(F.size(many) == 1, F.get(many, 0))
