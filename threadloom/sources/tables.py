"""The test tables as inputs of the graph: artifacts, claims, names, model answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def issues(spark: SparkSession, folder: str) -> DataFrame:
    """A document is an issue's body, the conversation of the same number its comments."""
    says = read(spark, folder, "conversations").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("said")
    )
    none = F.array().cast("array<string>")
    comment = "array<struct<comment_id:string,author:string,body:string,created_at:string,updated_at:string,url:string>>"
    said = F.transform(
        "said",
        lambda t: F.struct(
            t["turn"].cast("string").alias("comment_id"),
            F.when(t["role"] == "system", "github-actions[bot]").otherwise(t["role"]).alias("author"),
            F.coalesce(t["text"], F.lit("")).alias("body"),
            F.lit(None).cast("string").alias("created_at"),
            F.lit(None).cast("string").alias("updated_at"),
            F.lit(None).cast("string").alias("url"),
        ),
    ).cast(comment)
    null = F.lit(None).cast("string")
    d = read(spark, folder, "documents").join(says, F.col("doc_id") == F.col("conv_id"), "left")
    return d.select(
        F.col("doc_id").cast("string").alias("source_id"),
        F.col("doc_id").alias("number"),
        F.when(F.col("doc_id") % 3 == 0, "PR").otherwise("Issue").alias("type"),
        null.alias("url"),
        F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"),
        F.coalesce("text", F.lit("")).alias("body"),
        F.col("source").alias("author"),
        F.lit("closed").alias("state"),
        F.array("lang").alias("labels"),
        none.alias("assignees"),
        null.alias("created_at"), null.alias("closed_at"), null.alias("updated_at"),
        F.coalesce(said, F.array().cast(comment)).alias("comments"),
        none.alias("reviewers"),
    )


def claims(spark: SparkSession, folder: str) -> DataFrame:
    """Each order line says that a supplier uses, depends on or fixes a brand, as sure as its discount is small."""
    line = read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_discount", "l_shipdate")
    supplier = read(spark, folder, "supplier").select("s_suppkey", "s_name")
    part = read(spark, folder, "part").select("p_partkey", "p_brand")
    rows = line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    flag = F.col("l_returnflag")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    order = F.concat(F.lit("order_"), text("l_orderkey"))
    chunk = F.concat_ws("_", order, F.col("l_linenumber").cast("string"))
    return rows.select(
        F.concat(F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.lit("/"), F.col("l_linenumber").cast("string")).alias("pos"),
        F.col("s_name").alias("subject"),
        F.when(flag == "A", "uses").when(flag == "N", "depends_on").otherwise("fixes").alias("relation"),
        F.col("p_brand").alias("object"),
        (F.lit(1) - F.lit(5) * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(6,2)").alias("confidence"),
        F.concat(F.lit("order "), text("l_orderkey"), F.lit(" line "), text("l_linenumber")).alias("excerpt"),
        F.lit(False).alias("negated"),
        F.lit(None).cast("string").alias("source_url"),
        order.alias("artifact_id"),
        chunk.alias("chunk_id"),
        F.col("l_orderkey").alias("issue_number"),
        F.lit(None).cast("string").alias("author"),
        F.col("l_shipdate").cast("date").cast("string").alias("timestamp"),
        F.lit(0).cast("bigint").alias("offset_start"),
        F.lit(0).cast("bigint").alias("offset_end"),
    )


def aliases(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as components, by the balance's sign more or less frequent, and brands as libraries."""
    none = F.array().cast("array<string>")
    s = read(spark, folder, "supplier").select(
        F.col("s_name").alias("canonical"), none.alias("aliases"), F.lit("Component").alias("type"), (F.col("s_suppkey") % 17 + 1).alias("frequency")
    )
    brands = read(spark, folder, "part").groupBy("p_brand").agg(F.count("*").alias("frequency"))
    return s.union(brands.select(F.col("p_brand").alias("canonical"), none.alias("aliases"), F.lit("Library").alias("type"), "frequency"))


def answers(spark: SparkSession, folder: str) -> DataFrame:
    """What a model could have answered about each part: plain, fenced, in prose, broken, not an object, and worse.

    Parts are short rows in few files, answers and their validation much work, so parts are dealt to all cores first.
    """
    parts = read(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    p = parts.repartition(4 * spark.sparkContext.defaultParallelism, "p_partkey").select(
        F.col("p_partkey").alias("k"), F.regexp_replace("p_name", '["\\\\]', "").alias("n"), F.col("p_brand").alias("b"), "p_size"
    )
    body = F.format_string(
        '{"entities": [{"name": " %s ", "type": "Library"}, {"name": "%s", "type": "Gadget"}, {"name": "  "}],'
        ' "claims": [{"subject": "%s", "relation": "%s", "object": "%s", "evidence_excerpt": "%s", "confidence": %s},'
        ' {"subject": "%s", "relation": "uses", "object": "%s"}]}',
        "n", "b", "n",
        F.when(F.col("k") % 4 == 0, "USES").when(F.col("k") % 4 == 1, "strongly depends_on").when(F.col("k") % 4 == 2, "eats").otherwise("fixes"),
        F.when(F.col("k") % 5 == 0, F.lit("maker of things")).otherwise(F.col("b")),
        F.when(F.col("k") % 6 == 0, "").otherwise("it says so"),
        F.when(F.col("k") % 7 == 0, '"0.9"').when(F.col("k") % 7 == 1, "0.49").when(F.col("k") % 7 == 2, "1.7").when(F.col("k") % 7 == 3, "null").otherwise("0.5"),
        "b", "b",
    )
    form = F.col("k") % 8
    text = (
        F.when(form == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(form == 2, F.concat(F.lit("Here you are: "), body, F.lit(" Anything else?")))
        .when(form == 3, F.lit("I can't do that."))
        .when(form == 4, F.concat(F.lit("["), body, F.lit("]")))
        .otherwise(body)
    )
    null = F.lit(None).cast("string")
    return p.select(
        F.format_string("part_%06d_chunk_0", "k").alias("chunk_id"),
        F.format_string("part_%06d", "k").alias("artifact_id"),
        F.col("k").alias("issue_number"),
        null.alias("source_url"), null.alias("author"), null.alias("timestamp"),
        F.lit(0).cast("bigint").alias("offset_start"), F.lit(0).cast("bigint").alias("offset_end"),
        text.alias("response"), null.alias("error"),
    )
