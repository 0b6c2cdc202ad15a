"""Lines of hour files to post rows and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.json import again, broken, decode, field, mistyped
from feedloom.functions.text import first_filled, has_english, langs_json, variant_langs
from feedloom.functions.times import created_day, created_hour
from feedloom.schemas import POST_LINE

REQUIRED = ("uri", "did", "rkey", "created_at", "time_us")


TEXTS = (
    "kind", "uri", "cid", "did", "repo", "rkey", "created_at", "text",
    "reply_parent", "reply_root", "quote_uri",
)


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add the fields of a flat post and ``outcome``: ``post``, ``ignored`` or the failed field."""
    langs = field("langs")
    no_langs = F.try_variant_get(langs, "$", "string") == ""
    return decode(lines, column, POST_LINE).select(
        *lines.columns,
        *[field(name).alias(name) for name in TEXTS],
        _time_us().alias("time_us"),
        F.when(no_langs, F.array().cast("array<string>")).otherwise(variant_langs(langs)).alias("langs"),
        _outcome().alias("outcome"),
    )


def _time_us() -> Column:
    return F.try_variant_get(field("time_us"), "$", "bigint")


def _outcome() -> Column:
    named = field("uri").isNotNull() | again("uri").isNotNull()
    is_post = F.coalesce(field("kind") == "post", F.lit(False)) & named
    return (
        F.when(mistyped() | broken(), "json")
        .when(~is_post, "ignored")
        .otherwise(F.coalesce(_first_missing(), F.lit("post")))
    )


def _first_missing() -> Column:
    # A list, not a chain of conditions: its code is split up, where a chain grows into one method
    # too long for the JVM to compile.
    missing = []
    for name in REQUIRED:
        text = F.try_variant_get(field(name), "$", "string") if name == "time_us" else field(name)
        # The number zero counts as missing, the text "0" does not.
        zero = F.schema_of_variant(again(name)) != "STRING"
        empty = F.when(text.isin("0", "0.0", "false"), zero).otherwise(text.isNull() | (text == ""))
        if name == "time_us":
            empty = empty | _time_us().isNull()
        missing.append(F.when(empty, name))
    return F.get(F.array_compact(F.array(*missing)), F.lit(0))


def valid_posts(
    parsed: DataFrame, indexed_at: Column, file_day: Column, arrival: Column
) -> DataFrame:
    """Accepted lines in the shape of the posts table.

    ``arrival`` orders the rows of one post; ``indexed_at`` is one value per import of a file.
    """

    def no(kind: str) -> Column:
        return F.lit(None).cast(kind)

    return parsed.where(F.col("outcome") == "post").select(
        file_day.alias("file_day"),
        "uri",
        first_filled(F.col("did"), F.col("repo")).alias("author_did"),
        "rkey",
        "cid",
        "created_at",
        "time_us",
        indexed_at.alias("indexed_first"),
        indexed_at.alias("indexed_last"),
        "text",
        "reply_parent",
        "reply_root",
        "quote_uri",
        langs_json(F.col("langs")).alias("langs_json"),
        has_english(F.col("langs")).alias("lang_en"),
        F.lit(0).alias("has_embedding"),
        *derived_columns(),
        no("string").alias("emb_model"),
        no("int").alias("emb_dims"),
        no("array<float>").alias("emb_vec"),
        arrival.alias("arrival"),
    )


def derived_columns() -> list[Column]:
    """Columns that follow from the other columns of a post."""
    return [
        F.col("reply_parent").isNotNull().cast("int").alias("is_reply"),
        F.col("quote_uri").isNotNull().cast("int").alias("is_quote"),
        created_day(F.col("created_at")).alias("created_day"),
        created_hour(F.col("created_at")).alias("created_hour"),
    ]


def is_reject() -> Column:
    return ~F.col("outcome").isin("post", "ignored")


def rejected_lines(parsed: DataFrame, column: str = "value") -> DataFrame:
    """Lines that claim to be posts but lack a required field, and lines that are no JSON."""
    return parsed.where(is_reject()).select(
        F.col(column).alias("value"), F.col("outcome").alias("reason")
    )
