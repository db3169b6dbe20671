"""Queries of rankings under other settings, labels, metrics and cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.operators import variants
from tessera.plans.coverage import r6
from tessera.plans.registry import query
from tessera.plans.views import Views, islands_text

#: A second scheme calls every circular sequence a plasmid.
_LABELS = "SELECT 'default' AS scheme, sample, sequence_id, molecule_type, length FROM v_truth UNION ALL SELECT 'circular' AS scheme, sample, sequence_id, CASE WHEN is_circular THEN 'PLASMID' ELSE 'CHROMOSOME' END AS molecule_type, length FROM v_truth"
_COHORTS = "SELECT CASE WHEN region < 3 THEN 'west' ELSE 'east' END AS cohort, sample FROM v_sheet UNION ALL SELECT 'clonal' AS cohort, sample FROM v_sheet WHERE clonal_group IS NOT NULL"
_SET = ", ".join(f"('{n}', {q}, {i})" for n, (q, i) in variants.SETTINGS.items())
_CTES = f"""
lab AS ({_LABELS}), coh AS ({_COHORTS}),
kept AS (SELECT setting, sample, tool, tname, greatest(0, least(tstart, tend)) AS s, least(tlen, greatest(tstart, tend)) AS e FROM v_aln JOIN (SELECT * FROM (VALUES {_SET}) t(setting, q, ident)) ON is_primary AND block_length >= 200 AND mapq >= q AND CAST(matches AS DOUBLE) / block_length >= ident),
{islands_text("cover", "kept", "setting, sample, tool, tname")},
counts AS (SELECT h.*, total - tp AS fn FROM (SELECT setting, scheme, c.sample, tool, sum(CASE WHEN molecule_type = 'PLASMID' THEN e - s ELSE 0 END) AS tp, sum(CASE WHEN molecule_type = 'CHROMOSOME' THEN e - s ELSE 0 END) AS fp FROM cover c JOIN lab ON sequence_id = tname WHERE setting = 'default' OR scheme = 'default' GROUP BY ALL) h
  JOIN (SELECT scheme, sample, sum(length) AS total FROM lab WHERE molecule_type = 'PLASMID' GROUP BY ALL) USING (scheme, sample)),
rate AS (SELECT CASE WHEN setting = 'default' AND scheme = 'default' THEN 'baseline' WHEN scheme = 'default' THEN 'setting:' || setting ELSE 'scheme:' || scheme END AS variant, sample, tool, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1, tp / nullif(tp + fp, 0) AS prec, tp / nullif(tp + fn, 0) AS rec FROM counts),
val AS (SELECT * FROM (SELECT variant, sample, tool, f1 AS value FROM rate UNION ALL SELECT 'metric:precision', sample, tool, prec FROM rate WHERE variant = 'baseline' UNION ALL SELECT 'metric:recall', sample, tool, rec FROM rate WHERE variant = 'baseline'
  UNION ALL SELECT 'cohort:' || cohort, sample, tool, f1 FROM rate JOIN coh USING (sample) WHERE variant = 'baseline') WHERE value IS NOT NULL),
mean AS (SELECT variant, tool, avg(value) AS mean, count(*) AS n FROM val WHERE (variant, sample) IN (SELECT (variant, sample) FROM (SELECT variant, sample, count(DISTINCT tool) AS has FROM val GROUP BY ALL) JOIN (SELECT variant, count(DISTINCT tool) AS tools FROM val GROUP BY ALL) USING (variant) WHERE has = tools) GROUP BY ALL),
placed AS (SELECT *, row_number() OVER w AS place, first_value(tool) OVER w AS top FROM mean WINDOW w AS (PARTITION BY variant ORDER BY round(mean, 9) DESC, tool)),
base AS (SELECT tool, place AS baseline_place FROM placed WHERE variant = 'baseline'),
tau AS (SELECT a.variant, avg(sign((a.place - b.place) * (x.baseline_place - y.baseline_place))) AS tau FROM placed a JOIN placed b ON a.variant = b.variant AND a.tool < b.tool JOIN base x ON x.tool = a.tool JOIN base y ON y.tool = b.tool GROUP BY a.variant)"""


@query("j16_ranks_in_every_variant", "SELECT variant, p.tool, round(mean, 6) AS mean, n, place, baseline_place, baseline_place - place AS moved, round(tau, 6) AS tau, top, top = (SELECT tool FROM base WHERE baseline_place = 1) AS same_top FROM placed p LEFT JOIN base USING (tool) LEFT JOIN tau USING (variant)", _CTES)
def j16(v: Views) -> DataFrame:
    found = variants.compared(variants.table(variants.counts(v.v_aln, v.sql(_LABELS)), v.sql(_COHORTS)))
    return r6(found, "mean", "tau")
