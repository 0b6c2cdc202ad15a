"""Table shapes and fixed values."""

from __future__ import annotations

# --- fixed values: constants of the feed protocol and of the public web front end ---
POST_COLLECTION = "app.bsky.feed.post"
QUOTE_TYPES = ("app.bsky.embed.record", "app.bsky.embed.record#view")
PROFILE_URL = "https://bsky.app/profile/"

# --- fixed values: default operating parameters ---
MIN_TEXT_LENGTH = 10
ENCODE_BATCH = 128
EMBEDDING_DIMS = 384
EXPORT_CHUNK_ROWS = 10_000
EXPORT_DAYS = 3
SEARCH_K = 5
FLUSH_SECONDS = 3

# How recorded and landed texts are written.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

# One feed message. A variant is a field whose type is looked at.
MESSAGE = """
    did STRING, repo STRING, time_us VARIANT, kind STRING,
    commit STRUCT<
        operation STRING, collection STRING, rkey STRING, cid STRING,
        record STRUCT<
            text STRING, createdAt STRING, langs VARIANT,
            reply STRUCT<parent STRUCT<uri STRING>, root STRUCT<uri STRING>>,
            embed STRUCT<`$type` STRING, record STRUCT<uri STRING>>
        >
    >
"""

# One post as it lies in an hour file.
POST_LINE = """
    kind STRING, uri STRING, cid STRING, did STRING, repo STRING, rkey STRING, created_at STRING,
    time_us VARIANT, text STRING, reply_parent STRING, reply_root STRING, quote_uri STRING,
    langs VARIANT
"""

# One merged post of a day.
POSTS = """
    file_day STRING, uri STRING, author_did STRING, rkey STRING, cid STRING, created_at STRING,
    time_us BIGINT, indexed_first BIGINT, indexed_last BIGINT, text STRING, reply_parent STRING,
    reply_root STRING, quote_uri STRING, langs_json STRING, lang_en INT, has_embedding INT,
    is_reply INT, is_quote INT, created_day STRING, created_hour STRING,
    emb_model STRING, emb_dims INT, emb_vec ARRAY<FLOAT>
"""

# A vector for a post of a day.
POST_VECTORS = "file_day STRING, uri STRING, emb_vec ARRAY<FLOAT>, emb_model STRING"

# One post in the older shape.
OLDER_POSTS = """
    uri STRING, repo STRING, rkey STRING, created_at STRING, created_date STRING, created_hour INT,
    text STRING, langs STRING, raw_json STRING, embedding STRING, embedding_blob BINARY
"""

# One exported post.
EXPORT_COLUMNS = (
    "uri", "created_at", "created_date", "created_hour", "text", "embedding", "post_url",
)
EXPORT = """
    uri STRING, created_at STRING, created_date STRING, created_hour INT, text STRING,
    embedding ARRAY<FLOAT>, post_url STRING
"""

# One searchable vector; the text travels with it.
VECTORS = "uri STRING, text STRING, embedding ARRAY<FLOAT>"
