"""From chunks to validated extractions: the prompt, a pluggable model, repair and validation, and their totals."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings
from ..functions.model_json import extract_json
from ..functions.text import strip
from ..schemas import ENTITY_TYPES, RELATIONS

INSTRUCTIONS = (
    "Extract knowledge from a software discussion as one JSON object with the keys entities (name, type) and claims "
    "(subject, relation, object, evidence_excerpt, confidence, subject_type, object_type). Types: "
    + " | ".join(ENTITY_TYPES)
    + ". Relations: "
    + " | ".join(RELATIONS)
    + ". Quote evidence word for word, invent nothing, give confidence from 0 to 1, and return JSON only."
)


def prompt(text: Column, settings: Settings = DEFAULT) -> Column:
    head = F.substring(text, 1, settings.prompt_chars)
    return F.concat(F.lit(INSTRUCTIONS + '\n\nText to analyse:\n"""\n'), head, F.lit('\n"""'))


def ask_model(chunks: DataFrame, call: Callable[[str, int], str], settings: Settings = DEFAULT, attempts: int = 3, sleep=time.sleep) -> DataFrame:
    """The chunks of people with the model's answer, or the last error after `attempts` tries.

    `call(prompt, attempt)` runs on executors, one request for a row; Spark retries a lost task as a whole.
    """
    rows = chunks.where(~F.coalesce("is_bot", F.lit(False))).withColumn("prompt", prompt(F.col("text"), settings))
    columns = ["chunk_id", "artifact_id", "issue_number", "source_url", "author", "timestamp", "offset_start", "offset_end"]
    rows = rows.select(*columns, "prompt")
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != "prompt") + ", response string, error string"

    def run(batches):
        for pdf in batches:
            answers, errors = [], []
            for text in pdf.pop("prompt"):
                answer, error = None, None
                for attempt in range(attempts):
                    try:
                        answer, error = call(text, attempt), None
                        break
                    except TimeoutError:
                        error = "model_timeout"
                        sleep(2)
                    except Exception as e:  # noqa: BLE001  any failure of the service becomes an error row
                        error = str(e)
                        sleep(1)
                answers.append(answer)
                errors.append(error)
            yield pdf.assign(response=pd.Series(answers, dtype=object, index=pdf.index), error=pd.Series(errors, dtype=object, index=pdf.index))

    return rows.mapInPandas(run, schema)


def read_answers(rows: DataFrame) -> DataFrame:
    """Adds extraction (VARIANT) and marks answers without JSON as errors."""
    rows = rows.withColumn("extraction", extract_json(F.col("response")))
    return rows.withColumn("error", F.coalesce("error", F.when(F.col("extraction").isNull(), F.lit("json_parse_failed"))))


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "string")


def _relation(raw: Column) -> Column:
    """A relation of the vocabulary; else the first of it that the text contains; else null."""
    within = F.filter(F.array(*(F.lit(r) for r in RELATIONS)), lambda r: F.contains(raw, r))
    return F.when(raw.isin(*RELATIONS), raw).otherwise(F.get(within, F.lit(0)))


def _claim(c: Column, settings: Settings) -> Column:
    """The repaired claim with why, or a null relation where it must go."""
    s, o, e = (strip(F.coalesce(_field(c, x), F.lit(""))) for x in ("subject", "object", "evidence_excerpt"))
    r = _relation(F.lower(strip(F.coalesce(_field(c, "relation"), F.lit("")))))
    given = F.coalesce(_field(c, "confidence").try_cast("double"), F.lit(settings.default_confidence))
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), given))
    keep = (s != "") & (o != "") & (s != o) & (confidence >= settings.min_confidence)
    evidence = F.when(e == "", F.concat_ws(" ", s, r, o)).otherwise(e)
    shown = lambda x: F.coalesce(_field(c, x), F.lit("?"))
    return F.struct(
        F.struct(
            s.alias("subject"),
            F.when(keep, r).alias("relation"),
            o.alias("object"),
            F.substring(evidence, 1, settings.evidence_chars).alias("evidence_excerpt"),
            F.round(confidence, 4).alias("confidence"),
            F.coalesce(_field(c, "subject_type"), F.lit("unknown")).alias("subject_type"),
            F.coalesce(_field(c, "object_type"), F.lit("unknown")).alias("object_type"),
            F.coalesce(F.try_variant_get(c, "$.negated", "boolean"), F.lit(False)).alias("negated"),
        ).alias("claim"),
        F.concat(F.lit("dropped_claim:"), shown("subject"), F.lit("-"), shown("relation"), F.lit("-"), shown("object")).alias("issue"),
    )


def _quoted(text: Column) -> Column:
    """As messages show a text: in single quotes, or in double ones if only these are free."""
    plain = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        plain = F.replace(plain, F.lit(raw), F.lit(shown))
    single, double = F.contains(text, F.lit("'")), F.contains(text, F.lit('"'))
    escaped = F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(single & ~double, F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(escaped)


def _long(text: Column) -> Column:
    return F.when(F.length(text) > 200, F.concat(_quoted(text), F.lit(" is too long")))


def _short(text: Column) -> Column:
    return F.when(F.length(text) < 5, F.concat(_quoted(text), F.lit(" is too short")))


def _outside(kind: Column) -> Column:
    return F.when(~kind.isin(*ENTITY_TYPES), F.concat(_quoted(kind), F.lit(f" is not one of {list(ENTITY_TYPES)}")))


def validate(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Rows with extraction (VARIANT) → the same with extraction repaired and typed, validation_issues and counts before.

    Everything is one projection of array functions: nothing is shuffled, no row is dropped. What is not an object
    becomes an empty extraction with an issue. The first value that breaks the schema, entities before claims, is told as
    a schema_error. Missing endpoints of claims join the entities, subject first.
    """
    v = F.col("extraction")
    is_object = F.startswith(F.coalesce(F.schema_of_variant(v), F.lit("")), F.lit("OBJECT"))
    arr = lambda x: F.coalesce(F.try_variant_get(v, f"$.{x}", "array<variant>"), F.array().cast("array<variant>"))
    rows = rows.withColumn("raw_entities", F.when(is_object, arr("entities")).otherwise(F.array().cast("array<variant>")))
    rows = rows.withColumn("raw_claims", F.when(is_object, arr("claims")).otherwise(F.array().cast("array<variant>")))
    kind = lambda e: F.when(_field(e, "type").isin(*ENTITY_TYPES), _field(e, "type")).otherwise("unknown")
    named = F.transform(
        "raw_entities",
        lambda e: F.struct(strip(F.coalesce(_field(e, "name"), F.lit(""))).alias("name"), kind(e).alias("type")),
    )
    rows = rows.withColumn("named", named).withColumn("judged", F.transform("raw_claims", lambda c: _claim(c, settings)))
    rows = rows.withColumn("entities", F.filter("named", lambda e: e["name"] != ""))
    kept = F.filter("judged", lambda c: c["claim"]["relation"].isNotNull())
    rows = rows.withColumn("claims", F.transform(kept, lambda c: c["claim"]))
    ends = F.flatten(
        F.transform(
            "claims",
            lambda c: F.array(
                F.struct(c["subject"].alias("name"), c["subject_type"].alias("type")),
                F.struct(c["object"].alias("name"), c["object_type"].alias("type")),
            ),
        )
    )
    rows = rows.withColumn("ends", ends)
    first = F.filter(
        "ends",
        lambda e, k: ~F.exists("entities", lambda x: x["name"] == e["name"])
        & ~F.exists(F.slice("ends", F.lit(1), k), lambda x: x["name"] == e["name"]),
    )
    rows = rows.withColumn("added", first)
    breaches = F.concat(
        F.flatten(F.transform(F.concat("entities", "added"), lambda e: F.array(_long(e["name"]), _outside(e["type"])))),
        F.flatten(F.transform("claims", lambda c: F.array(_long(c["subject"]), _long(c["object"]), _short(c["evidence_excerpt"])))),
    )
    rows = rows.withColumn("breaches", F.filter(breaches, lambda b: b.isNotNull()))
    none = F.array().cast("array<string>")
    issues = F.concat(
        F.when(~is_object, F.array(F.lit("extraction_not_dict"))).otherwise(none),
        F.transform(F.filter(F.arrays_zip("named", "raw_entities"), lambda z: z["named"]["name"] == ""), lambda z: F.concat(F.lit("dropped_entity:"), F.to_json(z["raw_entities"]))),
        F.transform("added", lambda e: F.concat(F.lit("auto_added_entity:"), e["name"])),
        F.transform(F.filter("judged", lambda c: c["claim"]["relation"].isNull()), lambda c: c["issue"]),
        F.when(F.size("breaches") > 0, F.array(F.concat(F.lit("schema_error:"), F.substring(F.get("breaches", F.lit(0)), 1, 120)))).otherwise(none),
    )
    rows = rows.withColumn("validation_issues", issues)
    rows = rows.withColumn("entities_before", F.size("raw_entities")).withColumn("claims_before", F.size("raw_claims"))
    rows = rows.withColumn("extraction", F.struct(F.concat("entities", "added").alias("entities"), F.col("claims")))
    return rows.drop("raw_entities", "raw_claims", "named", "judged", "ends", "added", "breaches", "entities", "claims")


def validation_rows(validated: DataFrame) -> DataFrame:
    return validated.select(
        "chunk_id",
        "entities_before",
        F.size("extraction.entities").alias("entities_after"),
        "claims_before",
        F.size("extraction.claims").alias("claims_after"),
        F.col("validation_issues").alias("issues"),
    )


def validation_report(validated: DataFrame) -> DataFrame:
    """Totals and how many percent are left; entities may exceed 100 as endpoints are added."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}")
    out = validation_rows(validated).agg(
        F.count("*").alias("total_records"),
        *(total(f"{x}_{w}") for x in ("entities", "claims") for w in ("before", "after")),
    )
    for one, many in (("entity", "entities"), ("claim", "claims")):
        share = F.lit(100) * F.col(f"total_{many}_after") / F.greatest(F.col(f"total_{many}_before"), F.lit(1))
        out = out.withColumn(f"{one}_retention_pct", F.round(share, 1))
    return out


def extraction_totals(validated: DataFrame) -> DataFrame:
    return validated.agg(
        F.count("*").alias("chunks"),
        F.count_if(F.col("error").isNotNull()).alias("errors"),
        F.coalesce(F.sum(F.size("extraction.entities")), F.lit(0)).alias("entities"),
        F.coalesce(F.sum(F.size("extraction.claims")), F.lit(0)).alias("claims"),
    )


def _position(nth: str) -> Column:
    """Where in the input something was said, as text that sorts as the numbers in it do: issue, artifact, chunk, place."""
    chunk = F.regexp_extract("chunk_id", r"_chunk_(\d+)$", 1)
    comment = F.regexp_extract("artifact_id", r"_comment_(\d+)$", 1)
    parts = (F.col("issue_number").cast("string"), comment, F.col("artifact_id"), chunk, F.col("chunk_id"), F.col(nth).cast("string"))
    wide = lambda c: F.lpad(F.coalesce(c, F.lit("")), 20, "0")
    return F.concat_ws("/", *(c if k in (2, 4) else wide(c) for k, c in enumerate(parts)))


def raw_claims(validated: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """A row for each claim with where it was said; pos is its place in the input's order."""
    c = validated.select("*", F.posexplode("extraction.claims").alias("nth", "c"))
    return c.select(
        _position("nth").alias("pos"),
        F.col("c.subject").alias("subject"),
        F.col("c.relation").alias("relation"),
        F.col("c.object").alias("object"),
        F.coalesce("c.confidence", F.lit(settings.default_confidence)).alias("confidence"),
        F.col("c.evidence_excerpt").alias("excerpt"),
        F.col("c.negated").alias("negated"),
        "source_url", "artifact_id", "chunk_id", "issue_number", "author", "timestamp",
        F.coalesce("offset_start", F.lit(0)).alias("offset_start"),
        F.coalesce("offset_end", F.lit(0)).alias("offset_end"),
    )


def mentioned_entities(validated: DataFrame) -> DataFrame:
    """(name, type, pos) of every entity in every record."""
    e = validated.select("chunk_id", "artifact_id", "issue_number", F.posexplode("extraction.entities").alias("nth", "e"))
    pos = _position("nth")
    return e.select(strip(F.col("e.name")).alias("name"), F.col("e.type").alias("type"), pos.alias("pos")).where("name <> ''")
