"""Queries of resampling by strata: species-balanced means of the tools' scores, clusters being studies."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.operators import stratified
from tessera.plans.boards import PAIRS, values
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.resampling import differences
from tessera.plans.views import Views

_PARTS = PAIRS + """, sums AS (SELECT a, b, species, study, sum(d) AS s, count(*) AS n FROM prs JOIN v_sheet USING (sample) GROUP BY ALL),
parts AS (SELECT a, b, row_number() OVER (PARTITION BY a, b ORDER BY study) - 1 AS i, c, count(*) OVER (PARTITION BY a, b) AS g FROM (SELECT a, b, study, sum(s / n_k / k) AS c FROM (SELECT *, sum(n) OVER (PARTITION BY a, b, species) AS n_k FROM sums) JOIN (SELECT a, b, count(DISTINCT species) AS k FROM sums GROUP BY ALL) USING (a, b) GROUP BY ALL))"""


@query("j04_stratified_sign_flip", """
SELECT a, b, clusters, round(observed, 6) AS observed, round(avg(CASE WHEN abs(t) >= abs(observed) - 1e-9 THEN 1.0 ELSE 0.0 END), 6) AS p, true AS exact FROM (SELECT a, b, any_value(g) AS clusters, any_value(o) AS observed, sum(CASE WHEN (mask >> i) & 1 = 1 THEN c ELSE -c END) AS t
FROM (SELECT *, sum(c) OVER (PARTITION BY a, b) AS o FROM parts WHERE g BETWEEN 6 AND 13) JOIN (SELECT unnest(range(0, 8192)) AS mask) ON mask < (1 << g) GROUP BY a, b, mask) GROUP BY a, b, clusters, observed""", _PARTS)  # fmt: skip
def j04(v: Views) -> DataFrame:
    """Thirteen studies: all sign patterns of them."""
    return r6(stratified.sign_flip(differences(v), ["a", "b"], "study", "species", "difference", exact=13), "observed", "p")


@query("j06_stratified_bootstrap_t")
def j06(v: Views) -> DataFrame:
    """By Gram group, as a stratum needs two studies."""
    rows = values(v).join(v.v_sheet.select("sample", "study"), "sample").join(v.v_isolate.select("sample", "gram_group"), "sample")
    return stratified.bootstrap(rows, ["tool"], "study", "gram_group", "value", True)


@query("j07_interval_by_rule")
def j07(v: Views) -> DataFrame:
    return stratified.interval(values(v).join(v.v_sheet, "sample"), ["tool"], "study", "value", bounds=(0.0, 1.0))
