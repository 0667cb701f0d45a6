import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.config import Settings
from threadloom.functions.similarity import token_set_ratio
from threadloom.operators import claims as C
from threadloom.operators import extraction, flatten, governance, graph, resolution, retrieval
from threadloom.operators.components import components
from threadloom.plans import api, build, queries
from threadloom.sources import tables

RAW = "pos string, subject string, relation string, object string, confidence double, excerpt string, negated boolean, source_url string, artifact_id string, chunk_id string, issue_number bigint, author string, timestamp string, offset_start bigint, offset_end bigint"


def raw(spark, rows):
    return spark.createDataFrame([(f"{k:04}", s, r, o, c, x, False, None, a, "c", 1, None, t, 0, 0) for k, (s, r, o, c, x, a, t) in enumerate(rows)], RAW)


@pytest.fixture(scope="module")
def claims(spark):
    return raw(
        spark,
        [
            ("A", "uses", "B", 0.9, "A uses B in the core", "a1", "2024-01-02"),
            ("a", "uses", "b", 0.8, "A uses B in the core!", "a2", "2024-01-01"),
            ("A", "uses", "B", 0.7, "entirely other words here", "a3", None),
            ("A", "fixes", "B", 0.9, "fix", "a1", "2024-01-05"),
            ("A", "tests", "B", 0.9, "one", "a1", "2024-01-05"),
            ("B", "uses", "C", 0.5, "x", "a4", ""),
            ("C", "uses", "C", 0.6, "loop", "a5", "2024-02-01"),
        ],
    )


def test_claims(spark, claims):
    rows = {(r.subject, r.relation, r.object): r for r in C.deduplicated(claims).collect()}
    ab = rows["a", "uses", "b"]
    assert (ab.support_count, ab.confidence, ab.first_seen, ab.last_seen, ab.superseded) == (3, 0.8, None, "2024-01-02", False)
    assert [e.artifact_id for e in ab.evidence] == ["a3", "a2"]  # a1's excerpt resembles a2's
    assert rows["a", "fixes", "b"].superseded and rows["a", "tests", "b"].superseded
    assert set(ab.conflict_with) == {rows["a", "fixes", "b"].claim_id, rows["a", "tests", "b"].claim_id}
    report = C.conflict_report(C.merged(claims)).collect()
    assert {(r.relation_a, r.relation_b) for r in report} == {("fixes", "tests"), ("fixes", "uses"), ("tests", "uses")}
    assert sum(r.support_count for r in rows.values()) == 7


def test_graph_and_api(spark, claims):
    edges = graph.edges(C.deduplicated(claims)).cache()
    index = spark.createDataFrame([("A", ["aa"], "Component", 5), ("b", [], "Library", 2)], "canonical string, aliases array<string>, type string, frequency bigint")
    nodes = graph.nodes(C.deduplicated(claims), index).cache()
    assert {(r.id, r.type, r.frequency) for r in nodes.collect()} == {("a", "Component", 5), ("b", "Library", 2), ("c", "unknown", 1)}
    strict = graph.nodes(C.deduplicated(claims), index, Settings(strict=True))
    assert {(r.id, r.type) for r in strict.collect()} == {("a", "unknown"), ("b", "Library"), ("c", "unknown")}
    assert [r.relation for r in api.memory(nodes, edges, "A").collect()] == ["uses"]
    assert api.memory(nodes, edges, "nobody").count() == 0
    assert api.node(nodes, edges, "A").first().outgoing_count == 1
    with pytest.raises(api.NotFound):
        api.node(nodes, edges, "nobody")
    with pytest.raises(api.OutOfRange):
        api.top_nodes(nodes, None, 1001)
    old = edges.where("relation = 'fixes'").first().edge_id
    with pytest.raises(api.Gone):
        api.evidence(edges, old)
    assert api.evidence(edges, old, include_superseded=True).count() == 1
    near = graph.neighbourhood(edges, "a", 3)
    loop = edges.where("subject = 'c'").first().edge_id
    assert [(r.depth, r.edge_id == loop) for r in near.orderBy("depth", "edge_id").collect()].count((3, True)) == 2
    assert near.where("depth = 1").count() == 1
    with pytest.raises(api.NotFound, match="similar"):
        api.graph_search(nodes, edges, "bx")
    page = api.viewer(nodes, edges)
    assert page.startswith("<!DOCTYPE html>") and "a --uses--" in page
    small, kept = graph.subgraph(nodes, edges, limit=1)
    assert [r.id for r in small.collect()] == ["a"] and kept.count() == 0
    assert {r.name: r.n for r in api.stats(nodes, edges).where("kind = 'graph'").collect()} == {"nodes": 3, "edges": 5, "superseded": 2, "active": 3, "conflicted": 3}


def test_normalisation(spark):
    nodes = spark.createDataFrame([("Docs", "docs", 0), ("d_o-cs", "concept", 1), ("x.y z", "t", 2)], "id string, type string, pos int")
    edges = spark.createDataFrame([("e1", "DOCS", "uses", "New_One")], "edge_id string, subject string, relation string, object string")
    n, e = graph.normalize(nodes, edges)
    assert {(r.id, r.type) for r in n.collect()} == {("docs", "concept"), ("x.y z", "t"), ("newone", "unknown")}
    assert [(r.subject, r.object) for r in e.collect()] == [("docs", "newone")]
    again, _ = graph.normalize(n.withColumn("pos", F.col("id")), e)
    assert {r.id for r in again.collect()} == {r.id for r in n.collect()}


def test_components_are_the_closure(spark):
    rng = random.Random(5)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)]
    label = list(range(61))
    for _ in range(61):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.range(61), spark.createDataFrame(links, "a long, b long"))
    assert {r.id: r.component for r in got.collect()} == dict(enumerate(label))


def test_blocking_loses_no_pair(spark):
    rng = random.Random(9)
    words = ["route", "router", "routing", "pydantic", "pydantc", "core", "app", "fast", "api", "docs", "pr"]
    keys = sorted({" ".join(rng.sample(words, rng.randint(1, 4))) for _ in range(80)} | {"z z z z z z z z z z configuraton", "z configuration", "z", "z z"})
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {(r.a, r.b) for r in resolution.similar_keys(df).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(keys, 2) if token_set_ratio(a, b) >= 0.82}


def test_blocking_is_lossless_and_narrow_on_edited_names(spark):
    rng = random.Random(4)
    letters = "etaoinshrdlucmfw"
    made = {" ".join("".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(rng.randint(1, 3))) for _ in range(300)}
    for key in list(made):
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(key))
            made.add((key[:k] + rng.choice(["", rng.choice(letters), key[k] + rng.choice(letters)]) + key[k + 1 :]).strip())
    keys = sorted(made)
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    met = {(r.a, r.b) for r in resolution.candidates(df, 0.82).collect()}
    pairs = list(itertools.combinations(keys, 2))
    assert {p for p in pairs if token_set_ratio(*p) >= 0.82} <= met and len(met) < 0.02 * len(pairs)


def test_resolution(spark):
    names = ["FastAPI", "FastAPI", "fastapi", "routing.py", "routing", "Pydantic", "Pydantc", "the", "Other"]
    df = spark.createDataFrame([(n, "Library" if k % 2 else "Component", f"{k:03}") for k, n in enumerate(names)], "name string, type string, pos string")
    canonical, index, _ = resolution.resolve(df)
    got = {r.raw_name: r.canonical for r in canonical.collect()}
    assert got["routing"] == got["routing.py"] == "routing.py" and got["Pydantc"] == "Pydantic"
    assert got["FastAPI"] == "FastAPI" and got["fastapi"] == "fastapi" and got["the"] == "the"
    assert all(got[c] == c for c in set(got.values()))
    assert {r.canonical: r.frequency for r in index.collect()}["FastAPI"] == 2
    merged, _, _ = resolution.resolve(df, merge_equal_keys=True)
    assert {r.raw_name: r.canonical for r in merged.collect()}["fastapi"] == "FastAPI"


ANSWERS = [
    ('{"entities":[{"name":" X ","type":"Library"},{"name":""},{"name":"Y","type":"Odd"}],"claims":[{"subject":"X","relation":"USES","object":"Z","confidence":"0.9"}]}', 3, 1),
    ('{"entities":[],"claims":[{"subject":"a","relation":"uses","object":"a"},{"subject":"a","relation":"eats","object":"b"},{"subject":"a","relation":"uses","object":"b","confidence":0.49},{"subject":"a","relation":"it tests","object":"b","confidence":7}]}', 2, 1),
    ("[1]", 0, 0),
    ("no json", 0, 0),
]


def test_validation(spark):
    rows = spark.createDataFrame(
        [(f"c{k}", "a", k, None, None, None, 0, 0, t, None) for k, (t, _, _) in enumerate(ANSWERS)],
        "chunk_id string, artifact_id string, issue_number bigint, source_url string, author string, timestamp string, offset_start bigint, offset_end bigint, response string, error string",
    )
    v = extraction.validate(extraction.read_answers(rows)).orderBy("chunk_id").cache()
    got = v.collect()
    assert [(len(r.extraction.entities), len(r.extraction.claims)) for r in got] == [(a, b) for _, a, b in ANSWERS]
    assert got[0].extraction.claims[0].evidence_excerpt == "X uses Z" and got[0].extraction.claims[0].confidence == 0.9
    assert got[1].extraction.claims[0].relation == "tests" and got[1].extraction.claims[0].confidence == 1.0
    assert "extraction_not_dict" in got[2].validation_issues and got[3].error == "json_parse_failed"
    assert sum(i.startswith("dropped_claim") for i in got[1].validation_issues) == 3
    report = extraction.validation_report(v).first()
    assert (report.total_entities_before, report.total_entities_after, report.claim_retention_pct) == (3, 5, 40.0)
    g = build.from_extractions(v)
    assert {r.id for r in g.nodes.collect()} == {"x", "z", "a", "b"}
    assert g.edges.count() == 2


def test_the_first_breach_of_the_schema_is_told(spark):
    claim = '{"subject": "A", "relation": "uses", "object": "%s", "evidence_excerpt": "%s", "confidence": 1, "subject_type": "%s"}'
    said = [claim % ("B", "A uses B", "Robot"), claim % ("B" * 201, "A uses it", "Library"), claim % ("B", "A uses B", "Library")]
    rows = spark.createDataFrame(
        [(f"c{k}", "a", k, None, None, None, 0, 0, f'{{"entities": [], "claims": [{c}]}}', None) for k, c in enumerate(said)],
        "chunk_id string, artifact_id string, issue_number bigint, source_url string, author string, timestamp string, offset_start bigint, offset_end bigint, response string, error string",
    )
    got = extraction.validate(extraction.read_answers(rows)).orderBy("chunk_id").collect()
    errors = [[i for i in r.validation_issues if i.startswith("schema_error:")] for r in got]
    assert errors[0] == [("schema_error:'Robot' is not one of " + str(list(schemas.ENTITY_TYPES)))[:133]]
    assert errors[1] == ["schema_error:'" + "B" * 119] and errors[2] == []


def test_ontology_of_trackers(spark):
    rows = [("assigned_to", "Issue", "Person"), ("decided_in", "Bug", "Thread"), ("uses", "Feature", "Library")]
    typed = spark.createDataFrame(rows, "relation string, subject_type string, object_type string")
    fits = lambda **k: {r.relation: r.fits for r in governance.ontology_check(typed, **k).collect()}
    assert fits() == {"assigned_to": None, "decided_in": None, "uses": True}
    assert fits(extra=True) == {"assigned_to": True, "decided_in": False, "uses": True}


def test_model_retries(spark):
    chunk = spark.createDataFrame([("c", "a", 1, None, None, None, 0, 0, "hello", False), ("d", "a", 1, None, None, None, 0, 0, "bad", False), ("e", "a", 1, None, None, None, 0, 0, "bot", True)],
        "chunk_id string, artifact_id string, issue_number bigint, source_url string, author string, timestamp string, offset_start bigint, offset_end bigint, text string, is_bot boolean")

    def call(prompt, attempt):
        if "bad" in prompt:
            raise ValueError("down")
        if attempt == 0:
            raise TimeoutError
        return "{}"

    rows = {r.chunk_id: r for r in extraction.ask_model(chunk, call, sleep=lambda s: None).collect()}
    assert set(rows) == {"c", "d"} and rows["c"].response == "{}" and rows["d"].error == "down"


def test_issues_to_chunks(spark):
    issue = '{"id":7,"number":3,"pull_request":{"url":"u"},"title":"T","body":null,"user":{"login":"bob"},"state":"closed","labels":[{"name":"l"}],"assignees":[],"created_at":"2024"}'
    comments = '[{"id":1,"user":{"login":"codecov[bot]"},"body":"One. Two."},{"id":2,"user":null,"body":"  "}]'
    reviews = '[{"user":{"login":"z"},"state":"APPROVED"},{"user":{"login":"z"},"state":"COMMENTED"},{"user":null,"state":"APPROVED"},{"user":{"login":"y"},"state":"DISMISSED"}]'
    issues = flatten.normalize_issues(spark.createDataFrame([(issue, comments, reviews)] * 2, "issue string, comments string, reviews string"))
    assert issues.first().reviewers == ["z"] and issues.count() == 1
    a = flatten.artifacts(issues)
    assert [f.name for f in a.schema] == [f.name for f in spark.createDataFrame([], schemas.ARTIFACTS).schema]
    c = {r.chunk_id: r for r in flatten.chunks(a).collect()}
    assert set(c) == {"issue_3_body_chunk_0", "issue_3_comment_1_chunk_0"} and c["issue_3_comment_1_chunk_0"].is_bot
    assert flatten.chunk_stats(a, flatten.chunks(a)).first().asDict() == {"total": 2, "bots": 1, "skipped": 1}


def test_retrieval(spark):
    texts = ["alpha beta gamma", "alpha beta delta", "alpha omega gamma", "nothing here"]
    d = spark.createDataFrame([(f"c{k}", t, False, "a", 1, None, None, None, 0, 0) for k, t in enumerate(texts)], "chunk_id string, text string, is_bot boolean, artifact_id string, issue_number int, author string, timestamp string, source_url string, offset_start int, offset_end int")
    postings, vocabulary = retrieval.fit(d)
    assert {r.term for r in vocabulary.collect()} == {"alpha", "beta", "gamma", "alpha beta"}
    assert [r.chunk_id for r in api.search("beta", d, postings, vocabulary).collect()] == ["c1", "c0"]
    assert api.search("zzz", d, postings, vocabulary).count() == 0
    norms = postings.groupBy("chunk_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-9 for r in norms)


def test_context_pack(spark, claims):
    """Mentions of snippets and question choose the claims; only the snippets' are reported."""
    texts = ["alpha beta gamma", "alpha beta delta", "alpha omega gamma", "nothing here"]
    d = spark.createDataFrame([(f"c{k}", t, False, "a", 1, None, None, None, 0, 0) for k, t in enumerate(texts)], "chunk_id string, text string, is_bot boolean, artifact_id string, issue_number int, author string, timestamp string, source_url string, offset_start int, offset_end int")
    named = claims.withColumn("subject", F.when(F.lower("subject") == "a", "alpha").otherwise(F.col("subject"))).withColumn("object", F.when(F.lower("object") == "b", "betamax").otherwise(F.col("object")))
    edges = graph.edges(C.deduplicated(named)).cache()
    index = spark.createDataFrame([], "canonical string, aliases array<string>, type string, frequency bigint")
    nodes = graph.nodes(C.deduplicated(named), index)
    fitted = retrieval.fit(d)
    pack = api.context("beta", d, *fitted, nodes, edges).first()
    assert [s.chunk_id for s in pack.evidence_snippets] == ["c1", "c0"] and pack.entities_found == ["alpha"]
    active = [e for e in edges.collect() if not e.superseded and "alpha" in (e.subject, e.object)]
    assert pack.total_claims == len(pack.graph_claims) == len(active) > 0
    empty = api.context("zzz betamax", d, *fitted, nodes, edges).first()
    assert (empty.total_evidence, empty.entities_found) == (0, []) and empty.total_claims > 0
    with pytest.raises(api.OutOfRange):
        api.context("beta", d, *fitted, nodes, edges, top_k_claims=21)


def test_registered_context_pack_has_evidence(spark):
    folder = "/root/testdata/sf0.001"
    shown = json.loads(queries.context_pack(spark, folder).first().claims)
    true = {r.claim_id: r.evidence for r in C.deduplicated(tables.claims(spark, folder)).collect()}
    assert shown and all(c["all_evidence_count"] == len(true[c["edge_id"]]) > 0 for c in shown)
    assert all(c["excerpt"] == true[c["edge_id"]][0].excerpt != "" for c in shown)


def test_governance(spark, claims):
    d = C.deduplicated(claims)
    keep = spark.createDataFrame([("a1",), ("a4",)], "artifact_id string")
    assert {(r.subject, r.relation) for r in governance.without_orphans(d, keep).collect()} == {("a", "fixes"), ("a", "tests"), ("b", "uses")}
    acl = keep.withColumn("user", F.lit("u"))
    assert governance.permitted(d, acl, "nobody").count() == 0
    assert {r.memory for r in governance.durability(d).collect()} == {"durable", "ephemeral"}
    old = governance.decayed(d, "2025-01-01", 366).where("relation = 'fixes'").first()
    assert old.current_confidence == pytest.approx(0.453, abs=0.01)


def test_answers_are_dealt_to_all_cores(spark):
    folder = "/root/testdata/sf0.01"
    one = tables.read(spark, folder, "part").rdd.getNumPartitions()
    dealt = extraction.validate(extraction.read_answers(tables.answers(spark, folder))).rdd.glom().map(len).collect()
    assert one == 1 and sum(n > 0 for n in dealt) >= spark.sparkContext.defaultParallelism and max(dealt) < sum(dealt) / 4
    assert sum(dealt) == tables.read(spark, folder, "part").count()
