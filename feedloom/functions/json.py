"""JSON texts decoded once, with a second look for the odd ones.

The typed decoder is fast but does not tell a missing field from a null one, nor an empty object
from one with unknown fields. ``again`` decodes the text once more in full; it belongs under a
condition that is seldom true.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPTIONS = {"columnNameOfCorruptRecord": "corrupt", "allowSingleQuotes": "false"}


def decode(lines: DataFrame, column: str, schema: str) -> DataFrame:
    """Add ``msg`` with the text (``raw``) and its fields (``ev``).

    ``inline`` keeps the decoded value out of reach of filter push-down, which would otherwise decode
    the text again for every condition.
    """
    fields = F.from_json(F.col(column), f"{schema}, corrupt STRING", OPTIONS)
    msg = F.struct(F.col(column).alias("raw"), fields.alias("ev"))
    return lines.select("*", F.inline(F.array(F.struct(msg.alias("msg")))))


def field(path: str) -> Column:
    return F.col(f"msg.ev.{path}")


def again(path: str, kind: str = "variant") -> Column:
    """The value at ``path`` in the full decoding; null only if it is missing."""
    return F.try_variant_get(F.try_parse_json("msg.raw"), f"$.{path}" if path else "$", kind)


def mistyped() -> Column:
    """The text was not fully decoded: no JSON, no object, or a field of another type."""
    return field("corrupt").isNotNull()


def broken() -> Column:
    """The text is not exactly one JSON value.

    The decoders stop behind the first value. So every text is also counted as the only element of a list
    and as the only field of an object in one; what follows a value shows in at least one of them.
    """
    raw = F.col("msg.raw")
    alone = F.json_array_length(F.concat(F.lit("["), raw, F.lit("]"))) == 1
    wrapped = F.json_array_length(F.concat(F.lit('[{"x":'), raw, F.lit("}]"))) == 1
    single = F.coalesce(alone & wrapped, F.lit(False))
    return ~single | (mistyped() & F.try_parse_json("msg.raw").isNull())
