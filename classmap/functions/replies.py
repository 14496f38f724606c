"""Reading model replies: strict JSON parsing, choice checks, value lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from classmap.functions.text import strip

STRICT = {"allowSingleQuotes": "false"}
# Fixed value: how much of an unreadable reply is quoted in the reason.
QUOTED_CHARS = 400


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once per row, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _whole_json(text: Column, schema: str) -> Column:
    """The text as exactly one JSON value of a schema; null when anything follows it."""
    boxed = F.concat(F.lit("["), text, F.lit("]"))
    values = F.from_json(boxed, f"array<{schema}>", STRICT)
    return _bound(values, lambda v: F.when(F.size(v) == 1, F.get(v, F.lit(0))))


def parse_json_reply(raw, schema: str = "map<string,string>") -> Column:
    """The reply as a JSON object: all of it, else its first ``{`` to its last ``}``."""
    text = strip(F.col(raw) if isinstance(raw, str) else raw)
    inner = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.coalesce(_whole_json(text, schema), _whole_json(inner, schema))


def validate_choice(raw, candidates) -> Column:
    """``struct(choice_id, reasoning)`` for a rerank reply.

    ``candidates`` is an array of structs with a ``class_id``. A failed or unreadable
    reply, or an id that was not offered, gives no choice and says why.
    """
    raw, candidates = (F.col(c) if isinstance(c, str) else c for c in (raw, candidates))
    raw = F.coalesce(raw, F.lit(""))
    return _bound(parse_json_reply(raw), lambda reply: _judged(raw, reply, candidates))


def _judged(raw: Column, reply: Column, candidates: Column) -> Column:
    none = F.lit(None).cast("string")
    choice = F.coalesce(F.element_at(reply, "choice_id"), F.lit("None"))
    said = F.when(
        F.map_contains_key(reply, "reasoning"),
        strip(F.coalesce(F.element_at(reply, "reasoning"), F.lit("None"))),
    ).otherwise(F.lit(""))
    known = F.array_contains(_ids(candidates), choice)
    unread = F.concat(F.lit("Unparseable LLM output: "), F.substring(raw, 1, QUOTED_CHARS))
    wrong = F.concat(F.lit("Invalid choice_id: "), choice)
    return (
        F.when(F.startswith(raw, F.lit("ERROR:")), F.struct(none.alias("choice_id"), raw.alias("reasoning")))
        .when(
            reply.isNull() | (F.size(reply) == 0),
            F.struct(none.alias("choice_id"), unread.alias("reasoning")),
        )
        .when(
            ~F.coalesce(known, F.lit(False)),
            F.struct(
                none.alias("choice_id"),
                F.when(said != "", said).otherwise(wrong).alias("reasoning"),
            ),
        )
        .otherwise(F.struct(choice.alias("choice_id"), said.alias("reasoning")))
    )


def _ids(candidates: Column) -> Column:
    return F.transform(candidates, lambda c: c["class_id"].cast("string"))


def resolve_choice(choice_id, candidates) -> Column:
    """Name of the chosen candidate."""
    choice_id, candidates = (F.col(c) if isinstance(c, str) else c for c in (choice_id, candidates))
    # The choice is looked up once, not once per candidate.
    at = F.array_position(_ids(candidates), choice_id).cast("int")
    return F.get(candidates, at - 1)["class_name"]


def parse_extraction(raw) -> Column:
    """``struct(values, units)`` from a JSON object or the first object of a list."""
    text = strip(F.coalesce(F.col(raw) if isinstance(raw, str) else raw, F.lit("")))
    row = "struct<values:array<string>,units:array<string>>"
    one = _whole_json(text, row)
    # Entries as raw JSON, so that a later one of another kind does not spoil the first.
    many = _whole_json(F.get(_whole_json(text, "array<string>"), F.lit(0)), row)
    got = F.coalesce(one, many)

    def texts(field: str) -> Column:
        empty = F.array().cast("array<string>")
        return F.transform(F.coalesce(got[field], empty), lambda x: F.coalesce(x, F.lit("None")))

    return F.struct(texts("values").alias("values"), texts("units").alias("units"))


def join_extraction(values) -> Column:
    return F.array_join(F.col(values) if isinstance(values, str) else values, "; ")
