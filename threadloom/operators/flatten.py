"""Issues to artifacts to chunks, and their counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.chunking import PLACES, chunker
from ..functions.text import strip
from ..schemas import BOTS, RAW_ISSUES

_USER = "struct<login:string>"
_ISSUE = (
    "id bigint, number bigint, pull_request struct<url:string>, html_url string, title string, body string, "
    f"user {_USER}, state string, labels array<struct<name:string>>, assignees array<{_USER}>, created_at string, "
    "closed_at string, updated_at string"
)
_COMMENTS = f"array<struct<id:bigint,user:{_USER},body:string,created_at:string,updated_at:string,html_url:string>>"
_REVIEWS = f"array<struct<user:{_USER},state:string>>"


def normalize_issues(raw: DataFrame) -> DataFrame:
    """Rows (issue, comments, reviews) of JSON text → the raw issue table; an id that pages repeat counts once."""
    r = raw.select(
        F.from_json("issue", _ISSUE).alias("i"),
        F.coalesce(F.from_json("comments", _COMMENTS), F.array().cast(_COMMENTS)).alias("c"),
        F.coalesce(F.from_json("reviews", _REVIEWS), F.array().cast(_REVIEWS)).alias("v"),
    )
    is_pr = F.col("i.pull_request").isNotNull()
    said = F.filter("v", lambda x: x["user"].isNotNull() & x["state"].isin("APPROVED", "CHANGES_REQUESTED", "COMMENTED"))
    none = F.array().cast("array<string>")
    comment = lambda x: F.struct(
        x["id"].cast("string").alias("comment_id"),
        x["user"]["login"].alias("author"),
        F.coalesce(x["body"], F.lit("")).alias("body"),
        x["created_at"].alias("created_at"),
        x["updated_at"].alias("updated_at"),
        x["html_url"].alias("url"),
    )
    return r.select(
        F.col("i.id").cast("string").alias("source_id"),
        F.col("i.number").alias("number"),
        F.when(is_pr, "PR").otherwise("Issue").alias("type"),
        F.col("i.html_url").alias("url"),
        F.col("i.title").alias("title"),
        F.coalesce("i.body", F.lit("")).alias("body"),
        F.col("i.user.login").alias("author"),
        F.col("i.state").alias("state"),
        F.coalesce(F.col("i.labels.name"), none).alias("labels"),
        F.coalesce(F.col("i.assignees.login"), none).alias("assignees"),
        "i.created_at",
        "i.closed_at",
        "i.updated_at",
        F.transform("c", comment).alias("comments"),
        F.when(is_pr, F.array_sort(F.array_distinct(F.transform(said, lambda x: x["user"]["login"])))).otherwise(none).alias("reviewers"),
    ).dropDuplicates(["source_id"])


def artifacts(issues: DataFrame) -> DataFrame:
    """A body row for each issue and a row for each comment; bodies are never marked as a bot's."""
    none = F.array().cast("array<string>")
    body = issues.select(
        F.format_string("issue_%d_body", "number").alias("artifact_id"),
        F.col("number").alias("issue_number"),
        F.lit("issue_body").alias("artifact_type"),
        F.col("type").alias("issue_type"),
        "state", "labels", "author", "reviewers", "assignees",
        F.col("created_at").alias("timestamp"),
        "closed_at", "updated_at",
        F.concat("title", F.lit("\n\n"), "body").alias("text"),
        F.col("url").alias("source_url"),
        F.lit(False).alias("is_bot"),
    )
    comment = issues.select("number", "type", "state", F.explode("comments").alias("c")).select(
        F.format_string("issue_%d_comment_%s", "number", "c.comment_id").alias("artifact_id"),
        F.col("number").alias("issue_number"),
        F.lit("comment").alias("artifact_type"),
        F.col("type").alias("issue_type"),
        "state", none.alias("labels"), F.col("c.author").alias("author"), none.alias("reviewers"), none.alias("assignees"),
        F.col("c.created_at").alias("timestamp"),
        F.lit(None).cast("string").alias("closed_at"),
        F.col("c.updated_at").alias("updated_at"),
        F.col("c.body").alias("text"),
        F.col("c.url").alias("source_url"),
        F.coalesce(F.col("c.author").isin(*BOTS), F.lit(False)).alias("is_bot"),
    )
    return body.unionByName(comment)


def artifact_stats(rows: DataFrame) -> DataFrame:
    body, comment = (F.col("artifact_type") == x for x in ("issue_body", "comment"))
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if("is_bot").alias("bots"),
        F.count_if(body).alias("bodies"),
        F.count_if(comment).alias("comments"),
        F.count_if(body & (F.col("issue_type") == "PR")).alias("pr_bodies"),
        F.count_if(body & (F.col("issue_type") == "Issue")).alias("issue_bodies"),
    )


def chunks(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Overlapping chunks of each artifact with text; a bot's text is one chunk. Narrow: nothing is shuffled."""
    rows = rows.withColumn("text", strip(F.coalesce("text", F.lit("")))).where("text <> ''").select(
        "artifact_id", "issue_number", "artifact_type", "issue_type", "state", "labels", "author", "timestamp", "source_url", "text", "is_bot"
    )
    people = rows.where("not is_bot")
    schema = ", ".join([*(f"{c} {t}" for c, t in people.dtypes), *(f"{c} int" for c in PLACES)])
    parts = people.mapInArrow(chunker(settings.chunk_size, settings.chunk_overlap), schema)
    end = F.length("text")
    whole = rows.where("is_bot").select("*", *(x.cast("int").alias(c) for x, c in zip((F.lit(0), F.lit(0), end, F.lit(0), end), PLACES)))
    return parts.unionByName(whole).select(
        F.format_string("%s_chunk_%d", "artifact_id", "nth").alias("chunk_id"),
        "artifact_id", "issue_number", "artifact_type", "issue_type", "state", "labels", "author", "timestamp", "source_url",
        F.col("start").cast("bigint").alias("offset_start"),
        F.col("end").cast("bigint").alias("offset_end"),
        F.col("source_start").cast("bigint").alias("source_start"),
        F.col("source_end").cast("bigint").alias("source_end"),
        "text",
        "is_bot",
    )


def chunk_stats(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    empty = rows.agg(F.count_if(strip(F.coalesce("text", F.lit(""))) == "").alias("skipped"))
    counts = pieces.agg(F.count("*").alias("total"), F.count_if("is_bot").alias("bots"))
    return counts.join(empty, F.lit(True))  # one row each


__all__ = ["RAW_ISSUES", "artifact_stats", "artifacts", "chunk_stats", "chunks", "normalize_issues"]
