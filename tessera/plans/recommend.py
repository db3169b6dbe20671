"""Queries of recommendations in every scope, and of the tool that a sample gets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import recommendation
from tessera.operators.recommendation import COUNTED, DEFINED, FIELDS
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.views import Views

#: Fewer samples than in a real study: 3, and a floor that some scopes don't reach.
LEAST_SAMPLES, LEAST_COVERAGE, FLOOR = 3, 0.8, 0.5
_SCOPE = "CASE {} ELSE 'overall' END AS scope, CASE {} ELSE 'all' END AS grp".format(" ".join(f"WHEN grouping({f}) = 0 THEN '{f}'" for f in FIELDS), " ".join(f"WHEN grouping({f}) = 0 THEN {f}" for f in FIELDS))
_CTES = f"""
known AS (SELECT sample, {", ".join(f"coalesce({f}, 'not_recorded') AS {f}" for f in FIELDS)} FROM v_isolate),
scored AS (SELECT * FROM v_quality JOIN known USING (sample)),
sums AS (SELECT {_SCOPE}, tool, count(*) AS n_scored, {", ".join(f"avg({c}) AS m_{c}" for c in DEFINED)}, {", ".join(f"avg(coalesce({c}, 0)) AS m_{c}" for c in COUNTED)} FROM scored GROUP BY GROUPING SETS ((tool), {", ".join(f"(tool, {f})" for f in FIELDS)})),
seen AS (SELECT scope, grp, CASE WHEN scope = 'overall' THEN (SELECT count(*) FROM v_isolate) ELSE n END AS n_samples FROM (SELECT {_SCOPE}, count(DISTINCT sample) AS n FROM scored GROUP BY GROUPING SETS ((), {", ".join(f"({f})" for f in FIELDS)}))),
runs AS (SELECT tool, coalesce(count(*) FILTER (status = 'failed') / nullif(count(*) FILTER (status IN ('completed', 'failed')), 0), 0) AS failure_rate, median(runtime_seconds) AS seconds, median(size) AS kb FROM v_status GROUP BY tool),
means AS (SELECT scope, grp, tool, n_scored, n_scored / n_samples AS coverage, coalesce(m_f1, 0) AS f1, coalesce(m_precision, 0) AS prec, coalesce(m_recall, 0) AS rec, coalesce(m_plasmid_recall, m_f1, 0) AS plasmid, m_bin_f1 AS bin_f1, failure_rate, seconds, kb,
  least(1, m_split_events + m_merge_events) * 0.03 + least(1, m_contamination_fraction) * 0.05 + least(1, m_ambiguous_bp / greatest(1, m_true_bp)) * 0.02 + least(1, m_excess_records / greatest(1, m_true_count)) * 0.02 AS structure FROM sums JOIN seen USING (scope, grp) JOIN runs USING (tool)),
whole AS (SELECT *, 0.45 * f1 + 0.13 * prec + 0.13 * rec + 0.18 * plasmid + 0.06 * coalesce(bin_f1, 1 - failure_rate) - 0.03 * failure_rate - structure - (0.02 * least(1, ln(1 + seconds) / ln(3601)) + 0.01 * least(1, kb / (16 * 1024 * 1024))) AS score,
  n_scored >= {LEAST_SAMPLES} AND coverage >= {LEAST_COVERAGE} AS eligible FROM means),
told AS (SELECT *, CASE WHEN NOT eligible THEN 'unsupported' WHEN n_scored / {LEAST_SAMPLES} >= 2 AND round(coverage - {LEAST_COVERAGE}, 12) >= 0.15 THEN 'high' WHEN n_scored / {LEAST_SAMPLES} >= 1.4 OR round(coverage - {LEAST_COVERAGE}, 12) >= 0.08 THEN 'moderate' ELSE 'low' END AS tier,
  CASE WHEN eligible AND row_number() OVER (PARTITION BY scope, grp ORDER BY eligible DESC, round(score, 9) DESC, round(f1, 9) DESC, tool DESC) = 1 THEN CASE WHEN round(f1, 12) >= {FLOOR} THEN 'primary' ELSE 'below_floor' END ELSE 'none' END AS recommendation FROM whole)"""


def told(v: Views) -> DataFrame:
    runs = v.v_status.withColumnRenamed("size", "peak_rss_kb")
    return recommendation.recommended(recommendation.quality(v.v_quality, v.v_isolate, runs), LEAST_SAMPLES, LEAST_COVERAGE, FLOOR)


@query("m01_recommendation_in_12_scopes", "SELECT scope, grp, tool, n_scored, round(coverage, 6) AS coverage, round(f1, 6) AS f1, round(failure_rate, 6) AS failure_rate, round(score, 6) AS decision_score, eligible, tier, recommendation FROM told", _CTES)
def m01(v: Views) -> DataFrame:
    rows = told(v).select("scope", "grp", "tool", "n_scored", "coverage", "f1", "failure_rate", "decision_score", "eligible", "tier", "recommendation")
    return r6(rows, "coverage", "f1", "failure_rate", "decision_score")


@query("m10_tool_of_each_sample", "SELECT sample, arg_min(tool, k) AS tool, arg_min(scope, k) AS scope FROM (SELECT i.sample, t.tool, t.scope, CASE t.scope WHEN 'organism' THEN 0 WHEN 'gram_group' THEN 1 ELSE 2 END AS k FROM v_isolate i LEFT JOIN (SELECT * FROM told WHERE recommendation = 'primary') t ON t.scope = 'organism' AND t.grp = i.organism OR t.scope = 'gram_group' AND t.grp = i.gram_group OR t.scope = 'overall') GROUP BY sample", _CTES)
def m10(v: Views) -> DataFrame:
    return recommendation.chosen(v.v_isolate, told(v))
