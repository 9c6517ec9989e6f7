"""Landing table: parse payloads once, classify outcomes, explode entity records.

A landing row is one response (or one failed request). Parsing uses
``try_parse_json`` so a malformed body becomes a failed-task row instead of
killing the job; the entity array must exist and be an array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.operators.flatten import GRP, PRE, REC
from feedlake.schemas import ENTITIES, ERRORS_TYPE

DOC = "_doc"
CONTEXT = ("task_index", "page", "competition_code", "season_start_year")


def _err(field: str, reason: str) -> Column:
    return F.struct(F.lit(field).alias("field"), F.lit(reason).alias("reason"))


def classify(landing: DataFrame, array_key: str) -> DataFrame:
    """Adds ``_doc`` (VARIANT) and rewrites ``status``/``error`` for unusable bodies.

    ok + body parses + ``array_key`` is an array  -> status ok
    body is not JSON                             -> failed, malformed_json
    array key missing / null / not an array      -> failed, missing_key / null_key / bad_key
    """
    doc = F.try_parse_json(F.col("payload"))
    with_doc = landing.withColumn(DOC, doc)
    arr = F.variant_get(F.col(DOC), "$." + array_key, "variant")
    problem = (
        F.when(F.col(DOC).isNull(), F.lit("malformed_json"))
        .when(arr.isNull(), F.lit("missing_key:" + array_key))
        .when(F.is_variant_null(arr), F.lit("null_key:" + array_key))
        .when(~F.schema_of_variant(arr).startswith("ARRAY"), F.lit("bad_key:" + array_key))
    )
    ok = F.col("status") == "ok"
    return with_doc.withColumns(
        {
            "error": F.when(ok, problem).otherwise(F.col("error")),
            "status": F.when(ok & problem.isNotNull(), F.lit("failed")).otherwise(F.col("status")),
        }
    )


def context_columns() -> list[Column]:
    """Request arguments that standings/scorers take from the request, not the payload."""
    return [
        F.col("task_index"),
        F.col("page"),
        F.col("params").getItem("competition").alias("competition_code"),
        F.col("params").getItem("season").try_cast("bigint").alias("season_start_year"),
    ]


def explode_records(landing: DataFrame, entity: str) -> DataFrame:
    """Landing rows -> one row per entity record with ``_rec`` (and ``_grp`` for standings).

    The body is parsed once: only the raw ``status`` column is filtered, and a
    body whose entity array is unusable yields no records (``try_variant_get``
    gives NULL, ``posexplode`` of NULL gives no rows); ``failed_tasks`` reports
    those rows. ``_pos`` keeps server order inside a page (scorers are a ranking).
    Standings: a group whose ``table`` is missing/null/not an array yields one
    placeholder row carrying ``_pre_errors``; an empty table yields no rows.
    """
    array_key, _, _ = ENTITIES[entity]
    ok = landing.where(F.col("status") == "ok")
    items = F.try_variant_get(F.try_parse_json(F.col("payload")), "$." + array_key, "array<variant>")
    if entity != "standings":
        return ok.select(*context_columns(), F.posexplode(items).alias("_pos", REC))

    groups = ok.select(*context_columns(), F.posexplode(items).alias("_gpos", GRP))
    # A table that reads as an array says that the group is an object holding one: only the other
    # groups are looked at type by type (the type of a group is worked out from every row of its table).
    groups = groups.select("*", F.try_variant_get(F.col(GRP), "$.table", "array<variant>").alias("_rows"))
    gt = F.schema_of_variant(F.col(GRP))
    table = F.variant_get(F.col(GRP), "$.table", "variant")
    tt = F.schema_of_variant(table)
    pre = F.filter(
        F.array(
            F.when(~gt.startswith("OBJECT"), _err("_group", "type")),
            F.when(gt.startswith("OBJECT") & tt.isNull(), _err("table", "missing")),
            F.when(tt == "VOID", _err("table", "null")),
            F.when(tt.isNotNull() & (tt != "VOID") & ~tt.startswith("ARRAY"), _err("table", "type")),
        ),
        lambda x: x.isNotNull(),
    )
    pre = F.when(F.col("_rows").isNull(), pre).otherwise(F.array().cast(ERRORS_TYPE))
    rows = F.coalesce("_rows", F.when(F.size(PRE) > 0, F.array(F.parse_json(F.lit("null")))))
    return groups.select(*CONTEXT, "_gpos", GRP, "_rows", pre.alias(PRE)).select(
        *CONTEXT, "_gpos", GRP, PRE, F.posexplode(rows).alias("_pos", REC))


def failed_tasks(landing: DataFrame, array_key: str) -> DataFrame:
    """One row per landing row that produced no usable payload."""
    return (
        classify(landing, array_key)
        .where(F.col("status") != "ok")
        .select("task_index", "endpoint", "page", "http_status", "attempts", "error")
    )
