"""Names, units and codes held in parentheses at the end of a line of text.

Everything works on the whole line with built-in string functions. Each parser
gives a struct that is null where the line does not have the asked-for shape.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlake.functions.scalars import strip


def _before(text: Column, tail: Column) -> Column:
    """``text`` without ``tail`` and the one delimiter in front of it."""
    return F.left(text, F.length(text) - F.length(tail) - 1)


def _up_to_close(text: Column) -> Column:
    return strip(F.substring_index(text, ")", 1))


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def national_parts(line: Column) -> Column:
    """``name (unit) (code)``: cut at the last two opening parentheses."""
    tail = F.substring_index(line, "(", -2)
    return F.when(
        _count(line, "(") >= 2,
        F.struct(
            strip(_before(line, tail)).alias("practice_name"),
            _up_to_close(F.substring_index(tail, "(", 1)).alias("practice_unit"),
            _up_to_close(F.substring_index(tail, "(", -1)).alias("practice_code"),
        ),
    )


def simple_parts(line: Column) -> Column:
    """``name (code)``: cut at the last opening parenthesis."""
    tail = F.substring_index(line, "(", -1)
    return F.when(
        F.contains(line, F.lit("(")),
        F.struct(
            strip(_before(line, tail)).alias("practice_name"),
            _up_to_close(tail).alias("practice_code"),
        ),
    )


def paren_depth(line: Column) -> Column:
    """Greatest nesting depth; a closing one at depth 0 is ignored; -1 if one stays open."""
    marks = F.split(F.regexp_replace(line, "[^()]", ""), "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("top"))

    def step(state: Column, mark: Column) -> Column:
        now = (
            F.when(mark == "(", state["now"] + 1)
            .when((mark == ")") & (state["now"] > 0), state["now"] - 1)
            .otherwise(state["now"])
        )
        return F.struct(now.alias("now"), F.greatest(state["top"], now).alias("top"))

    def finish(state: Column) -> Column:
        return F.when(state["now"] != 0, F.lit(-1)).otherwise(state["top"])

    # Most lines need no walk over their characters.
    return F.when(~F.contains(line, F.lit("(")), F.lit(0)).otherwise(F.aggregate(marks, start, step, finish))


def nested_parts(line: Column, depth: Column) -> Column:
    """Depth 1 as ``simple_parts``; deeper from the first opening to the last closing one."""
    name = F.substring_index(line, "(", 1)
    rest = F.substr(line, F.length(name) + 2)
    outer = F.struct(
        strip(name).alias("practice_name"),
        strip(_before(rest, F.substring_index(rest, ")", -1))).alias("practice_code"),
    )
    return F.when(depth > 1, outer).when(depth == 1, simple_parts(line))
