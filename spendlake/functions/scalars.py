"""Column-to-column cleaning expressions, all built in and code-generated."""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character that counts as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def quoted(name: str) -> str:
    """A column's exact name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """A column by its exact name, which may hold dots or parentheses."""
    return F.col(quoted(name))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def title_case(text: Column) -> Column:
    return F.initcap(F.lower(text))


def to_decimal(value: Column, precision: int, places: int, strict: bool = True) -> Column:
    """Round half up; the cast rounds by itself, from the shortest decimal form of a double.

    A number that does not fit is an error, or null when not strict.
    """
    kind = T.DecimalType(precision, places)
    return value.cast(kind) if strict else value.try_cast(kind)


def round2(value: Column) -> Column:
    """Round to cents in decimal, so no binary digit decides a tie."""
    return to_decimal(value, 30, 2)


def number(text: Column, kind: T.DataType, strict: bool = True) -> Column:
    """Text to number: blank is null; other bad text is an error, or null when not strict."""
    bare = strip(text)
    filled = F.when(bare != "", bare)
    parsed = filled.try_cast(kind)
    if not strict:
        return parsed
    wrong = filled.isNotNull() & parsed.isNull()
    return F.coalesce(parsed, F.when(wrong, F.raise_error(F.concat(F.lit("not a number: "), filled))))


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def normalise_code(code: Column) -> Column:
    """The first run of three digits in a code, or the whole code where there is none."""
    return F.coalesce(F.regexp_substr(code, F.lit(r"\d{3}")), code)


def display_name(name: Column, code: Column) -> Column:
    return F.concat(name, F.lit(" ("), code, F.lit(")"))


def type_of(name: str, types: Mapping[str, Sequence[str]], default: str = "unknown") -> str:
    """The type whose list of names holds a constant name."""
    return next((kind for kind, names in types.items() if name in names), default)


def classify(name: Column, types: Mapping[str, Sequence[str]], default: str = "unknown") -> Column:
    """The same for a column of names."""
    result = None
    for kind, names in types.items():
        member = name.isin(list(names))
        result = F.when(member, kind) if result is None else result.when(member, kind)
    return F.lit(default) if result is None else result.otherwise(default)


def literal(value: str | int) -> str:
    """A value as SQL text. Long lists go to the engine as one text, not one call per entry."""
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def missing_to_null(name: str, texts: Sequence[str]) -> Column:
    """A text column with the given spellings of "no value" as null."""
    return F.expr(f"CASE WHEN NOT {is_in(name, texts)} THEN {quoted(name)} END")


def is_in(name: str, values: Sequence[str | int]) -> str:
    """Membership of a column in a list, as SQL text."""
    return f"{quoted(name)} IN ({', '.join(literal(value) for value in values)})" if values else "false"


def look_up(key: Column, table: Mapping[str | int, str | int]) -> Column:
    """The entry of a literal table, null where there is none.

    A literal map is searched entry by entry, so the entries are dealt to about
    as many small maps by checksum, and a row searches the one its key falls into.
    """
    buckets: list[list] = [[] for _ in range(len(table) // 2 + 1)]
    for pair in table.items():
        buckets[zlib.crc32(str(pair[0]).encode()) % len(buckets)].append(pair)
    # A map needs an entry for its type; the one in an empty bucket belongs to another, so no key finds it there.
    any_pair = list(table.items())[:1]
    maps = [f"map({', '.join(literal(part) for pair in bucket or any_pair for part in pair)})" for bucket in buckets]
    place = F.crc32(key.cast("string").cast("binary")) % len(buckets) + 1
    return F.try_element_at(F.try_element_at(F.expr(f"array({', '.join(maps)})"), place.cast("int")), key)
