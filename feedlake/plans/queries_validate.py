"""Validation queries: lax coercion (V1) and quarantine of bad records (V2, V3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.coerce import int_div
from feedlake.operators.drift import drift_report
from feedlake.operators.entity import flatten_entity
from feedlake.operators.flatten import ERRORS, REC, flatten_records
from feedlake.plans.catalog import register
from feedlake.schemas import MATCH_FIELDS, FieldSpec
from feedlake.session import read_table
from feedlake.sources import feeds
from feedlake.sources.landing import explode_records

N_FIELD = (FieldSpec("n", "n", "long", "required"),)


def _variant_text(k, cust):
    """JSON text of ``{"n": ...}`` in one of twelve encodings of the integer ``k`` (by k % 12)."""
    ks = k.cast("string")
    forms = [
        F.concat(F.lit('{"n": '), ks, F.lit("}")),
        F.concat(F.lit('{"n": "'), ks, F.lit('"}')),
        F.concat(F.lit('{"n": " '), ks, F.lit(' "}')),
        F.concat(F.lit('{"n": "'), ks, F.lit('.0"}')),
        F.concat(F.lit('{"n": '), ks, F.lit(".0}")),
        F.when(cust % 2 == 0, F.lit('{"n": true}')).otherwise(F.lit('{"n": false}')),
        F.concat(F.lit('{"n": "'), int_div(k, 1000).cast("string"), F.lit("_"), F.lpad((k % 1000).cast("string"), 3, "0"),
                 F.lit('"}')),
        F.concat(F.lit('{"n": "+'), ks, F.lit('"}')),
        F.concat(F.lit('{"n": '), ks, F.lit(".5}")),
        F.concat(F.lit('{"n": "'), ks, F.lit('."}')),
        F.concat(F.lit('{"n": ['), ks, F.lit("]}")),
        F.lit('{"n": null}'),
    ]
    out = forms[-1]
    for i in range(len(forms) - 2, -1, -1):
        out = F.when(k % 12 == i, forms[i]).otherwise(out)
    return out


@register("coerce_lax", """
SELECT o_orderkey, CAST(o_orderkey % 12 AS BIGINT) AS kind,
       CASE WHEN o_orderkey % 12 IN (0, 1, 2, 3, 4, 6, 7) THEN o_orderkey
            WHEN o_orderkey % 12 = 5 THEN CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 0 END END AS n,
       CASE WHEN o_orderkey % 12 IN (8, 9, 10) THEN 'type' WHEN o_orderkey % 12 = 11 THEN 'null' END AS reason
FROM orders
""")
def q_coerce_lax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: twelve JSON encodings of an integer through the lax LONG rule (accept or reject)."""
    o = read_table(spark, sf_dir, "orders")
    recs = o.select("o_orderkey", F.parse_json(_variant_text(F.col("o_orderkey"), F.col("o_custkey"))).alias(REC))
    flat = flatten_records(recs, None, keep=("o_orderkey",), fields=N_FIELD)
    return flat.select("o_orderkey", (F.col("o_orderkey") % 12).alias("kind"), "n",
                       F.get(F.col(ERRORS), 0)["reason"].alias("reason"))


def corrupted_matches_landing(spark: SparkSession, sf_dir: str, more=lambda k, j: j) -> DataFrame:
    """Match pages with one defect per 50 orders (fixed rule, mirrored in the oracle):
    %50=1 winner key removed, 2 fullTime null, 3 homeTeam.id null, 4 startDate '20x4-..', 5 homeTeam.name a number.
    ``more`` changes the record's text once more, by the same remainder."""
    recs = feeds.match_records(spark, sf_dir)
    j = F.to_json("rec")
    k = F.col("rec.id") % 50
    bad = (F.when(k == 1, F.regexp_replace(j, r',?"winner":(null|"[A-Z_]*")', ""))
           .when(k == 2, F.regexp_replace(j, r'"fullTime":\{[^}]*\}', '"fullTime":null'))
           .when(k == 3, F.regexp_replace(j, r'"homeTeam":\{"id":[0-9]+', '"homeTeam":{"id":null'))
           .when(k == 4, F.regexp_replace(j, r'"startDate":"[0-9]{4}', '"startDate":"20x4'))
           .when(k == 5, F.regexp_replace(j, r'"homeTeam":\{"id":([0-9]+),"name":"[^"]*"', '"homeTeam":{"id":$1,"name":5'))
           .otherwise(j))
    pages = recs.select("competition", "season", "nation", "page", more(k, bad).alias("j")).groupBy(
        "competition", "season", "nation", "page").agg(F.collect_list("j").alias("js"))
    params = F.create_map(F.lit("competition"), F.col("competition"), F.lit("season"), F.col("season").cast("string"))
    payload = F.concat(F.lit('{"matches":['), F.array_join("js", ","), F.lit("]}"))
    return feeds._landing(pages, "competition_matches", F.col("nation") * 10000 + F.col("season"), params,
                          F.col("page"), payload)


@register("quarantine", """
SELECT o_orderkey AS match_id, f.field, f.reason
FROM orders, LATERAL (VALUES
  (1, 'winner', 'missing'), (2, 'home_score_ft', 'null_parent'), (2, 'away_score_ft', 'null_parent'),
  (3, 'home_team_id', 'null'), (4, 'season_start_year', 'bad_year'), (5, 'home_team_name', 'type')
) f(k, field, reason)
WHERE o_orderkey % 50 = f.k
""")
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2/V3: every failing field of every bad record, with the record kept for replay."""
    v = flatten_entity(corrupted_matches_landing(spark, sf_dir), "matches", "quarantine")
    return v.rejects.select(F.get_json_object("record", "$.id").cast("bigint").alias("match_id"), "field", "reason")


@register("schema_drift", """
WITH r AS (
  SELECT CAST(c.c_nationkey * 10000 + year(o.o_orderdate) AS BIGINT) AS task_index, o.o_orderkey // 1000 AS page, o.o_orderkey % 50 AS k
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT task_index, page, path, type, CAST(sum(times) AS BIGINT) AS n, drift
FROM r JOIN (VALUES
  (1, 'score.winner', NULL, 1, 'lost'), (2, 'score.fullTime', 'VOID', 1, 'changed'),
  (2, 'score.fullTime.home', NULL, 1, 'lost'), (2, 'score.fullTime.away', NULL, 1, 'lost'),
  (3, 'homeTeam.id', 'VOID', 1, 'changed'), (5, 'homeTeam.name', 'BIGINT', 1, 'changed'),
  (6, 'venue.name', 'STRING', 1, 'unknown'), (6, 'venue.tags[]', 'STRING', 2, 'unknown'), (6, 'venue["seat plan"]', 'ARRAY', 1, 'unknown'),
  (7, 'id', 'STRING', 1, 'changed')
) f(k, path, type, times, drift) ON r.k = f.k
GROUP BY ALL
""")
def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3/K3: unknown, lost and changed paths of each page, over the defects of ``quarantine`` and two more."""
    venue = '{"venue":{"name":"Arena","tags":["old","roof"],"seat plan":[]},'

    def more(k, j):
        return (F.when(k == 6, F.concat(F.lit(venue), F.substring(j, F.lit(2), F.length(j))))
                .when(k == 7, F.regexp_replace(j, '"id":([0-9]+),"utcDate"', '"id":"$1","utcDate"')).otherwise(j))

    records = explode_records(corrupted_matches_landing(spark, sf_dir, more), "matches")
    return drift_report(records, MATCH_FIELDS, ("task_index", "page"))
