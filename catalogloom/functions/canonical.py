"""Canonical JSON as an expression: sorted names, no spaces, fixed escapes, fixed forms of numbers.

The text equals that of Python's ``json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":"))`` for strings, whole
numbers, doubles, booleans, nulls, arrays, maps with text keys and structs, so that hashes made elsewhere are met.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegralType, MapType, StringType, StructType

from .cells import let

#: Characters with an escape of their own; other control characters are written by their code.
ESCAPES = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


def _text(c: Column) -> Column:
    plain = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    escaped = plain
    for code in range(0x20):
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(ESCAPES.get(chr(code), f"\\u{code:04x}")))
    return F.concat(F.lit('"'), F.when(c.rlike("[\\x00-\\x1f]"), escaped).otherwise(plain), F.lit('"'))


def _double(c: Column) -> Column:
    """Python's form of the shortest digits: exponents below -4 and from 16 on are written, others shift the point."""
    said = c.cast("string")
    digits = F.regexp_replace(F.regexp_extract(said, r"^-?([0-9.]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(said, r"E(-?\d+)$", 1).cast("int")
    bare = F.replace(digits, F.lit("."), F.lit(""))
    tail = F.char_length(bare) - 1
    shifted = F.when(tail > power, F.concat(F.left(bare, power + 1), F.lit("."), F.right(bare, tail - power))).otherwise(F.concat(bare, F.repeat(F.lit("0"), power - tail), F.lit(".0")))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), bare)
    exponent = F.concat(digits, F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.when(F.abs(power) < 10, "0").otherwise(""), F.abs(power).cast("string"))
    form = F.when(power.between(7, 15), shifted).when(power == -4, small).otherwise(exponent)
    return F.when(F.isnan(c), "NaN").when(c == float("inf"), "Infinity").when(c == float("-inf"), "-Infinity").when(F.contains(said, F.lit("E")), F.concat(F.when(F.left(said, F.lit(1)) == "-", "-").otherwise(""), form)).otherwise(said)


def canonical_json(c: Column, kind: DataType) -> Column:
    """The canonical text of a column of type ``kind``."""
    if isinstance(kind, StringType):
        made = let(c, _text)
    elif isinstance(kind, (IntegralType, BooleanType)):
        made = c.cast("string")
    elif isinstance(kind, (DoubleType, FloatType)):
        made = let(c.cast("double"), _double)
    elif isinstance(kind, ArrayType):
        made = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: canonical_json(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, MapType) and isinstance(kind.keyType, StringType):
        entries = F.array_sort(F.map_entries(c), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        made = F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda e: F.concat(_text(e["key"]), F.lit(":"), canonical_json(e["value"], kind.valueType))), ","), F.lit("}"))
    elif isinstance(kind, StructType):
        pairs = [F.concat(_text(F.lit(f.name)), F.lit(":"), canonical_json(c[f.name], f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)]
        made = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    else:
        raise TypeError(f"no canonical form of {kind.simpleString()}")
    return F.when(c.isNull(), "null").otherwise(made)


def input_hash(record: Column, kind: DataType, prompt_version: str) -> Column:
    """sha256 of what a labeller was shown: a record under a prompt's version."""
    return F.sha2(F.concat(F.lit('{"prompt_version":'), _text(F.lit(prompt_version)), F.lit(',"record":'), canonical_json(record, kind), F.lit("}")), 256)
