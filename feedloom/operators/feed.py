"""Feed messages: decode, select new posts, flatten, classify the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.json import again, broken, decode, field, mistyped
from feedloom.functions.text import first_filled, post_uri, variant_langs
from feedloom.functions.times import written_date, written_hour
from feedloom.schemas import MESSAGE, POST_COLLECTION, QUOTE_TYPES


def parse_messages(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add ``msg``, the decoded message."""
    return decode(lines, column, MESSAGE)


def event_time() -> Column:
    """Event time as a number, whatever way it was written."""
    return F.try_variant_get(field("time_us"), "$", "bigint")


def _is_commit() -> Column:
    return F.coalesce(field("kind") == "commit", F.lit(False))


def _is_new_post() -> Column:
    return F.coalesce(
        (field("commit.operation") == "create") & (field("commit.collection") == POST_COLLECTION),
        F.lit(False),
    )


def _filled_record() -> Column:
    # A record with a date is not empty; only the others need the full look.
    return (
        F.when(field("commit.record.createdAt").isNotNull(), True)
        .when(field("commit.record").isNull(), False)
        .otherwise(F.schema_of_variant(again("commit.record")) != "OBJECT<>")
    )


def _empty_record() -> Column:
    """Missing, null, or an empty or zero value of any kind."""
    text = again("commit.record", "string")
    return text.isNull() | text.isin("{}", "[]", "", "0", "0.0", "false")


def _is_object() -> Column:
    return ~mistyped() | again("", "map<string,variant>").isNotNull()


def _commit_verdict() -> Column:
    no_commit = field("commit").isNotNull() | again("commit").isNull()
    no_rkey = F.when(field("commit.rkey").isNull(), again("commit.rkey").isNull()).otherwise(False)
    return (
        F.when(~_is_commit(), "skip")
        .when(~_is_new_post(), F.when(no_commit, "skip").otherwise("dead:commit"))
        .when(~_filled_record(), F.when(_empty_record(), "skip").otherwise("dead:record"))
        .when(no_rkey, "dead:rkey")
        .otherwise("post")
    )


def verdict() -> Column:
    """What becomes of a message: ``post``, ``skip``, or ``dead:`` and the defect.

    Skipped messages are other kinds of events. Dead ones cannot be read as what they claim to be.
    """
    integer_time = F.coalesce(F.schema_of_variant(field("time_us")) == "BIGINT", F.lit(False))
    return (
        F.when(broken(), "dead:json")
        .when(~integer_time, F.when(_is_object(), "skip").otherwise("dead:message"))
        .otherwise(_commit_verdict())
    )


def verdict_legacy() -> Column:
    """The same for the older selection, which does not look at the event time.

    Its posts have no later check of their author, and without author and key all posts of an author, or
    of a key, would share one address.
    """
    outcome = _commit_verdict()
    nameless = (outcome == "post") & field("did").isNull()
    keyless = (outcome == "post") & field("commit.rkey").isNull()
    return (
        F.when(broken(), "dead:json")
        .when(~_is_object(), "dead:message")
        .when(nameless, "dead:did")
        .when(keyless, "dead:rkey")
        .otherwise(outcome)
    )


def keep_posts(messages: DataFrame) -> DataFrame:
    """Newly created posts with an integer event time and a filled record."""
    return messages.where(verdict() == "post")


def keep_posts_legacy(messages: DataFrame) -> DataFrame:
    """The older selection: the same without a look at the event time, of posts with author and key."""
    return messages.where(verdict_legacy() == "post")


def dead_letters(
    messages: DataFrame, column: str = "value", outcome: Column | None = None
) -> DataFrame:
    """Unreadable messages with the defect found; ``outcome`` is ``verdict()`` unless given."""
    outcome = verdict() if outcome is None else outcome
    return messages.where(outcome.startswith("dead:")).select(
        F.col(column).alias("value"), F.substring_index(outcome, ":", -1).alias("reason")
    )


def flat_fields() -> list[Column]:
    """The 12 fields of a post."""
    did = first_filled(field("did"), field("repo"))
    rkey = field("commit.rkey")
    quoted = field("commit.record.embed.`$type`").isin(*QUOTE_TYPES)
    return [
        F.lit("post").alias("kind"),
        post_uri(did, rkey).alias("uri"),
        field("commit.cid").alias("cid"),
        did.alias("did"),
        rkey.alias("rkey"),
        _text_or_empty("commit.record.createdAt").alias("created_at"),
        event_time().alias("time_us"),
        _text_or_empty("commit.record.text").alias("text"),
        field("commit.record.reply.parent.uri").alias("reply_parent"),
        field("commit.record.reply.root.uri").alias("reply_root"),
        F.when(quoted, field("commit.record.embed.record.uri")).alias("quote_uri"),
        variant_langs(field("commit.record.langs")).alias("langs"),
    ]


def flatten_posts(messages: DataFrame, *keep: str) -> DataFrame:
    """The fields of a post, and the columns named in ``keep``."""
    return messages.select(*flat_fields(), *keep)


def _text_or_empty(path: str) -> Column:
    """A missing field is the empty text; an explicit null stays null."""
    return F.when(field(path).isNotNull(), field(path)).when(again(path).isNull(), "")


def legacy_posts(messages: DataFrame, *keep: str) -> DataFrame:
    """Posts in the older table shape. Posts without a readable date are left out."""
    did = field("did")
    rkey = field("commit.rkey")
    created_at = _text_or_empty("commit.record.createdAt")
    langs = field("commit.record.langs")
    return (
        messages.select(
            post_uri(did, rkey).alias("uri"),
            did.alias("repo"),
            rkey.alias("rkey"),
            created_at.alias("created_at"),
            written_date(created_at).alias("created_date"),
            written_hour(created_at).alias("created_hour"),
            _text_or_empty("commit.record.text").alias("text"),
            F.when(langs.isNotNull(), F.array_join(variant_langs(langs), ",")).alias("langs"),
            F.lit(None).cast("string").alias("raw_json"),
            F.lit(None).cast("string").alias("embedding"),
            F.lit(None).cast("binary").alias("embedding_blob"),
            *keep,
        )
        .where(F.col("created_date").isNotNull())
    )
