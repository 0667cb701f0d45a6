"""The batch build, from chunks' answers to the graph and its index, one lazy plan for each table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..config import DEFAULT, Settings
from ..operators import claims, extraction, graph, resolution, retrieval


@dataclass
class Graph:
    canonical: DataFrame
    alias_index: DataFrame
    merge_log: DataFrame
    claims: DataFrame
    conflicts: DataFrame
    nodes: DataFrame
    edges: DataFrame


def from_extractions(validated: DataFrame, settings: Settings = DEFAULT, normalize: bool = True) -> Graph:
    canonical, index, log = resolution.resolve(extraction.mentioned_entities(validated), settings)
    deduped = claims.deduplicated(extraction.raw_claims(validated, settings), canonical, settings)
    n, e = graph.nodes(deduped, index, settings), graph.edges(deduped)
    if normalize:
        n, e = graph.normalize(n, e)
    return Graph(canonical, index, log, deduped, claims.conflict_report(deduped), n, e)


def index(chunks: DataFrame, settings: Settings = DEFAULT) -> tuple[DataFrame, DataFrame]:
    return retrieval.fit(chunks, settings)
