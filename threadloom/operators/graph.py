"""The property graph: nodes and edges, endpoint normalisation, neighbourhoods, subgraphs and how they are drawn."""

from __future__ import annotations

import html
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.text import statement
from ..schemas import RELATION_COLOURS, TYPE_COLOURS
from .components import checkpointed

_NO_NAMES = "array<string>"


def edges(claims: DataFrame) -> DataFrame:
    return claims.withColumnRenamed("claim_id", "edge_id")


def nodes(claims: DataFrame, alias_index: DataFrame | None = None, settings: Settings = DEFAULT) -> DataFrame:
    """Every endpoint once, with when it was seen; type, aliases and frequency from the alias index.

    Endpoints are lower-cased; by default so are the index's keys (the most frequent name wins where several meet), in
    strict mode they must match as they are.
    """
    ends = claims.select(F.explode(F.array("subject", "object")).alias("id"), "first_seen", "last_seen")
    seen = ends.groupBy("id").agg(
        F.min(F.nullif("first_seen", F.lit(""))).alias("first_seen"), F.max(F.nullif("last_seen", F.lit(""))).alias("last_seen")
    )
    none = F.array().cast(_NO_NAMES)
    if alias_index is None:
        found = seen.select("*", F.lit(None).cast("string").alias("type"), none.alias("aliases"), F.lit(None).cast("bigint").alias("frequency"))
    else:
        key = F.col("canonical") if settings.strict else F.lower("canonical")
        index = alias_index.groupBy(key.alias("id")).agg(
            F.max(F.struct("frequency", "canonical", "type")).alias("top"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases")))).alias("aliases"),
            F.sum("frequency").alias("frequency"),
        )
        found = seen.join(index.select("id", F.col("top.type").alias("type"), "aliases", "frequency"), "id", "left")
    return found.select(
        "id",
        F.col("id").alias("label"),
        F.coalesce("type", F.lit("unknown")).alias("type"),
        F.coalesce("aliases", none).alias("aliases"),
        F.coalesce("frequency", F.lit(1)).cast("bigint").alias("frequency"),
        "first_seen",
        "last_seen",
    )


def graph_counts(node_rows: DataFrame, edge_rows: DataFrame) -> DataFrame:
    e = edge_rows.agg(
        F.count("*").alias("edges"),
        F.count_if(~active()).alias("superseded"),
        F.count_if(active()).alias("active"),
        F.count_if(F.size("conflict_with") > 0).alias("conflicted"),
    )
    return node_rows.agg(F.count("*").alias("nodes")).join(e, F.lit(True))  # one row each


def folded(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[_-]", "")


def normalize(node_rows: DataFrame, edge_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids lower-cased and without _ and -; nodes that meet are one, of the last one's type by `pos`.

    Endpoints without a node are added as unknown. Other node columns, where there are any: aliases are all aliases and
    folded ids, frequencies add up, first and last seen span all. Edges keep everything but their two ends.
    """
    out = edge_rows.withColumn("subject", folded(F.col("subject"))).withColumn("object", folded(F.col("object")))
    rich = "aliases" in node_rows.columns
    pos = F.col("pos") if "pos" in node_rows.columns else F.col("id")
    keyed = node_rows.select("*", folded(F.col("id")).alias("key"), pos.alias("at__"))
    sums = [F.max_by("type", "at__").alias("type")]
    if rich:
        sums += [
            F.array_sort(F.array_distinct(F.concat(F.flatten(F.collect_list("aliases")), F.collect_list("id")))).alias("aliases"),
            F.sum("frequency").alias("frequency"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        ]
    merged = keyed.groupBy("key").agg(*sums).withColumnRenamed("key", "id")
    if rich:
        merged = merged.withColumn("aliases", F.filter("aliases", lambda a: a != F.col("id"))).withColumn("label", F.col("id"))
    ends = out.select(F.explode(F.array("subject", "object")).alias("id")).distinct()
    lost = ends.join(merged, "id", "left_anti").withColumn("type", F.lit("unknown"))
    if rich:
        lost = lost.withColumn("label", F.col("id")).withColumn("frequency", F.lit(1).cast("bigint"))
        lost = lost.withColumn("aliases", F.array().cast(_NO_NAMES))
    return merged.unionByName(lost, allowMissingColumns=True), out


def active() -> Column:
    return ~F.coalesce("superseded", F.lit(False))


def visible(edge_rows: DataFrame, relation: str | None = None, include_superseded: bool = False) -> DataFrame:
    if relation:
        edge_rows = edge_rows.where(F.col("relation") == relation)
    return edge_rows if include_superseded else edge_rows.where(active())


def outgoing(edge_rows: DataFrame, entity: str, relation: str | None = None) -> DataFrame:
    return visible(edge_rows, relation).where(F.col("subject") == entity)


def incoming(edge_rows: DataFrame, entity: str, relation: str | None = None) -> DataFrame:
    return visible(edge_rows, relation).where(F.col("object") == entity)


def neighbourhood(edge_rows: DataFrame, start: str, max_depth: int = 2, relation: str | None = None) -> DataFrame:
    """Edges met in a breadth-first walk in both directions: (depth, edge_id, subject, relation, object).

    An edge comes once for each end that was expanded. One join for each level; visited nodes are never expanded again,
    so cycles cost nothing.
    """
    spark = edge_rows.sparkSession
    seen_edges = visible(edge_rows, relation).select("edge_id", "subject", "relation", "object")
    frontier = reached = spark.createDataFrame([(start, 0)], "id string, depth int")
    for depth in range(1, max_depth):
        near = seen_edges.join(frontier, F.col("subject") == F.col("id")).select(F.col("object").alias("id"))
        near = near.union(seen_edges.join(frontier, F.col("object") == F.col("id")).select(F.col("subject").alias("id")))
        frontier = checkpointed(near.distinct().join(reached, "id", "left_anti").withColumn("depth", F.lit(depth)))
        reached = reached.union(frontier)
    found = [
        seen_edges.join(reached, F.col(side) == F.col("id")).select((F.col("depth") + 1).alias("depth"), "edge_id", "subject", "relation", "object")
        for side in ("subject", "object")
    ]
    return found[0].union(found[1])


def hints(node_rows: DataFrame, name: str, n: int = 5) -> DataFrame:
    """Ids that hold the first five characters of a name that was not found."""
    return node_rows.where(F.contains("id", F.lit(name[:5]))).select("id").orderBy("id").limit(n)


def subgraph(node_rows: DataFrame, edge_rows: DataFrame, type_: str | None = None, relation: str | None = None, min_support: int = 1, limit: int = 300) -> tuple[DataFrame, DataFrame]:
    """The edges of a relation with enough support, between nodes of a type; the most frequent nodes and edges among them."""

    def between(e, n):
        ids = n.select("id")
        return e.join(ids.withColumnRenamed("id", "subject"), "subject", "left_semi").join(ids.withColumnRenamed("id", "object"), "object", "left_semi")

    e = edge_rows.where(F.coalesce("support_count", F.lit(1)) >= min_support)
    e = e.where(F.col("relation") == relation) if relation else e
    n = node_rows
    if type_:
        n = n.where(F.col("type") == type_)
        e = between(e, n)
    used = e.select(F.explode(F.array("subject", "object")).alias("id")).distinct()
    n = n.join(used, "id", "left_semi").orderBy(F.desc(F.coalesce("frequency", F.lit(1))), "id").limit(limit)
    return n, between(e, n)


def _colour(of: Column, table: dict[str, str]) -> Column:
    pairs = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.coalesce(F.try_element_at(pairs, of), F.lit("#aaa"))


def drawn_nodes(node_rows: DataFrame) -> DataFrame:
    frequency = F.coalesce(F.col("frequency").try_cast("bigint"), F.lit(1))
    names = F.when(F.size("aliases") > 0, F.array_join("aliases", ", ")).otherwise("—")
    title = F.concat_ws(
        "\n", F.col("id"), F.concat(F.lit("type: "), "type"), F.concat(F.lit("frequency: "), frequency.cast("string")),
        F.concat(F.lit("aliases: "), names), F.concat(F.lit("first seen: "), "first_seen"), F.concat(F.lit("last seen: "), "last_seen"),
    )
    return node_rows.select(
        "id",
        F.substring("id", 1, 30).alias("label"),
        F.least(F.lit(50), F.lit(15) + 2 * frequency).alias("size"),
        _colour(F.col("type"), TYPE_COLOURS).alias("colour"),
        title.alias("title"),
    )


def drawn_edges(edge_rows: DataFrame) -> DataFrame:
    support = F.coalesce(F.col("support_count").try_cast("bigint"), F.lit(1))
    proof = F.get("evidence", F.lit(0))
    old = F.coalesce("superseded", F.lit(False))
    title = F.concat_ws(
        "\n",
        statement(F.col("subject"), F.col("relation"), F.col("object")),
        F.format_string("confidence: %.2f", "confidence"),
        F.concat(F.lit("support: "), support.cast("string")),
        F.when(old, F.lit("superseded")),
        F.substring(proof["excerpt"], 1, 150),
        proof["source_url"],
    )
    return edge_rows.select(
        F.col("subject").alias("from"),
        F.col("object").alias("to"),
        F.col("relation").alias("label"),
        F.least(F.lit(10), F.lit(1) + support).alias("width"),
        F.when(old, F.lit("#555")).otherwise(_colour(F.col("relation"), RELATION_COLOURS)).alias("colour"),
        old.alias("dashes"),
        title.alias("title"),
    )


def render_html(node_rows: DataFrame, edge_rows: DataFrame, title: str = "Knowledge graph") -> str:
    """One page without outside resources. The subgraph's limit bounds what comes to the driver."""
    data = json.dumps(
        {"nodes": [r.asDict() for r in drawn_nodes(node_rows).collect()], "edges": [r.asDict() for r in drawn_edges(edge_rows).collect()]}
    ).replace("</", "<\\/")
    script = """
const g=JSON.parse(document.getElementById('g').textContent),v=document.getElementById('v'),N='http://www.w3.org/2000/svg',p={};
g.nodes.forEach((n,i)=>{const a=2*Math.PI*i/g.nodes.length,r=120+280*((i*7)%10)/10;p[n.id]=[500+r*Math.cos(a),450+r*Math.sin(a)]});
function put(k,a,t){const e=document.createElementNS(N,k);for(const x in a)e.setAttribute(x,a[x]);const s=document.createElementNS(N,'title');s.textContent=t;e.appendChild(s);v.appendChild(e)}
g.edges.forEach(e=>{const a=p[e.from],b=p[e.to];if(a&&b)put('line',{x1:a[0],y1:a[1],x2:b[0],y2:b[1],stroke:e.colour,'stroke-width':e.width/2,'stroke-dasharray':e.dashes?'4':''},e.title)});
g.nodes.forEach(n=>put('circle',{cx:p[n.id][0],cy:p[n.id][1],r:n.size/3,fill:n.colour},n.title));
"""
    return (
        f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body>"
        f"<svg id='v' viewBox='0 0 1000 900'></svg><script type='application/json' id='g'>{data}</script><script>{script}</script></body></html>"
    )


def shown_edges(edge_rows: DataFrame, node_rows: DataFrame) -> DataFrame:
    """One line of text for each edge, with its ends' types, and its first evidence."""
    kinds = node_rows.select("id", "type")
    e = edge_rows
    for side in ("subject", "object"):
        e = e.join(kinds.select(F.col("id").alias(side), F.col("type").alias(f"{side}_type")), side, "left")
    proof = F.get("evidence", F.lit(0))
    line = F.concat(
        statement(F.col("subject"), F.col("relation"), F.col("object")),
        F.format_string("  (%s -> %s)  confidence %.2f  support %d", F.coalesce("subject_type", F.lit("?")), F.coalesce("object_type", F.lit("?")), "confidence", "support_count"),
        F.when(active(), "").otherwise("  [SUPERSEDED]"),
    )
    return e.select("edge_id", line.alias("line"), F.translate(F.substring(proof["excerpt"], 1, 120), "\n", " ").alias("excerpt"), proof["source_url"].alias("source_url"))


def best_first() -> list[Column]:
    return [F.desc("support_count"), F.desc("confidence"), F.col("edge_id")]

