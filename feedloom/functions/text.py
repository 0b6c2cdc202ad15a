"""Text columns: post addresses, links, language lists, trimming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.schemas import POST_COLLECTION, PROFILE_URL


def post_uri(did: Column, rkey: Column) -> Column:
    """``at://did/collection/rkey``; a null part is spelled ``None``, as the feed writer does."""
    none = F.lit("None")
    return F.concat(
        F.lit("at://"), F.coalesce(did, none), F.lit(f"/{POST_COLLECTION}/"), F.coalesce(rkey, none)
    )


def first_filled(*columns: Column) -> Column:
    """The first column that is neither null nor empty; else the last one as it is."""
    *head, last = columns
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in head], last)


def public_link(uri: Column) -> Column:
    """Link to the web page of a post, with empty parts where the address is too short."""
    parts = F.split(uri, "/")
    handle = F.when(F.size(parts) > 2, F.get(parts, F.lit(2))).otherwise("")
    post_id = F.when(F.size(parts) > 3, F.element_at(parts, -1)).otherwise("")
    return F.when(
        uri.isNotNull(), F.concat(F.lit(PROFILE_URL), handle, F.lit("/post/"), post_id)
    )


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends; ``trim`` would remove blanks only."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def embed_text(text: Column, max_chars: int | None = None) -> Column:
    """What the encoder is given of a post: all of it, or the first ``max_chars`` characters if a caller says so."""
    return text if max_chars is None else F.substring(text, 1, max_chars)


def langs_json(langs: Column) -> Column:
    """Compact JSON list, with letters outside ASCII as ``\\u`` escapes."""
    text = F.to_json(langs)

    def escaped(letter: Column) -> Column:
        units = F.lower(F.hex(F.encode(letter, "UTF-16BE")))
        return F.when(F.octet_length(letter) == 1, letter).otherwise(
            F.regexp_replace(units, "(.{4})", r"\\u$1")
        )

    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, text).otherwise(F.array_join(F.transform(F.split(text, ""), escaped), ""))


def has_english(langs: Column) -> Column:
    """1 if ``en`` is exactly one of the languages; ``en-US`` does not count."""
    return F.coalesce(F.array_contains(langs, "en"), F.lit(False)).cast("int")


def variant_langs(langs: Column) -> Column:
    """Language list of a JSON value: a list stays, a text becomes a list of one, null is empty."""
    listed = F.try_variant_get(langs, "$", "array<string>")
    single = F.array(F.try_variant_get(langs, "$", "string"))
    return F.when(
        langs.isNull() | F.is_variant_null(langs), F.array().cast("array<string>")
    ).otherwise(F.coalesce(listed, single))
