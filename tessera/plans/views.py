"""The operators' inputs as views over the test tables, for Spark and, as common table expressions, for DuckDB."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels conversations".split()

TEXTS = {
    "v_truth": """
SELECT CAST(s_nationkey AS BIGINT) AS sample, s_suppkey AS sequence_id,
       CASE WHEN s_suppkey % 4 = 0 THEN 'CHROMOSOME' ELSE 'PLASMID' END AS molecule_type,
       20000 + (s_suppkey % 7) * 5000 AS length, s_suppkey % 3 = 1 AS is_circular
FROM supplier""",
    "v_aln": """
SELECT t.sample, l_returnflag AS tool, l_orderkey AS qname, CAST(1000 AS BIGINT) AS qlen,
       (l_partkey * 13) % 700 AS qstart, (l_partkey * 13) % 700 + CAST(l_quantity AS BIGINT) * 6 AS qend,
       CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand,
       l_suppkey AS tname, t.length AS tlen,
       (l_partkey * 97 + l_orderkey * 31) % (t.length - 400) AS tstart,
       (l_partkey * 97 + l_orderkey * 31) % (t.length - 400) + CAST(l_quantity AS BIGINT) * 6 AS tend,
       CAST(l_quantity AS BIGINT) * 6 - l_linenumber % 4 AS matches,
       CAST(l_quantity AS BIGINT) * 6 AS block_length,
       l_partkey % 61 AS mapq, l_linestatus = 'F' AS is_primary
FROM lineitem JOIN v_truth t ON l_suppkey = t.sequence_id""",
    "v_mapped": """
SELECT *, CASE WHEN qname % 11 = 0 THEN NULL ELSE CASE WHEN qstart % 5 > 0 THEN qstart % 5 || 'S' ELSE '' END || CASE WHEN qname % 3 = 1 THEN part || 'M' ELSE part || '=' || CASE WHEN x > 0 THEN x || 'X' ELSE '' END END
  || CASE WHEN i > 0 THEN i || 'I' ELSE '' END || CASE WHEN d > 0 THEN d || 'D' ELSE '' END || CASE WHEN qname % 3 = 1 THEN (block_length - part - d) || 'M' ELSE (block_length - part - x - d) || '=' END END AS cg,
  CASE WHEN qname % 13 <> 0 THEN x + i + d END AS nm
FROM (SELECT *, CAST(floor(block_length / 3.0) AS BIGINT) AS part, block_length - matches AS x, mapq % 5 AS i, qname % 4 AS d FROM v_aln)""",
    "v_record": "SELECT DISTINCT sample, tool, qname AS record_id, qlen AS length FROM v_aln",
    "v_prob": "SELECT o_orderkey AS record_id, CAST(o_custkey % 101 AS DOUBLE) / 100 AS probability FROM orders",
    "v_bins": "SELECT o_custkey % 30 AS bin_id, o_orderkey AS sequence_id FROM orders WHERE o_orderkey % 5 <> 0",
    "v_contig": """
SELECT p_partkey AS contig, 500 + (p_partkey * 37) % 9000 AS length,
       CAST(p_size AS BIGINT) AS depth, p_partkey % 25 AS sample,
       CASE WHEN p_size % 10 < 5 THEN 'PLASMID' WHEN p_size % 10 < 8 THEN 'CHROMOSOME'
            WHEN p_size % 10 = 8 THEN 'AMBIGUOUS' ELSE 'UNPLACED' END AS label,
       p_partkey % 40 AS best_plasmid, p_partkey % 3 <> 0 AS called, p_partkey % 17 AS bin_id
FROM part""",
    "v_gene": """
SELECT t.sample, p_partkey AS copy_id, t.sequence_id, p_brand AS gene_name, p_type AS gene_class,
       (p_partkey * 211) % (t.length - 1500) AS start_pos,
       (p_partkey * 211) % (t.length - 1500) + 300 + p_size * 10 AS end_pos,
       CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand
FROM part JOIN v_truth t ON p_partkey % (SELECT COUNT(*) FROM supplier) = t.sequence_id
WHERE t.molecule_type = 'PLASMID'""",
    "v_sheet": """
SELECT CAST(n_nationkey AS BIGINT) AS sample, CAST(n_nationkey % 4 AS BIGINT) AS species,
       CAST(n_nationkey % 13 AS BIGINT) AS study, CAST(n_regionkey AS BIGINT) AS region,
       CASE WHEN n_nationkey % 6 = 0 THEN CAST(n_nationkey % 2 AS BIGINT) END AS clonal_group
FROM nation""",
    "v_scores": """
SELECT t.sample, l_returnflag || l_linestatus AS tool,
       CASE WHEN SUM(l_partkey) % 19 = 0 THEN NULL ELSE CAST(SUM(l_partkey) % 1000 AS DOUBLE) / 1000 END AS f1,
       CAST(SUM(l_orderkey) % 1000 AS DOUBLE) / 1000 AS bin_f1,
       CAST(SUM(l_orderkey) % 7 AS BIGINT) AS correct, CAST(7 AS BIGINT) AS plasmids
FROM lineitem JOIN v_truth t ON l_suppkey = t.sequence_id
GROUP BY t.sample, l_returnflag || l_linestatus""",
    "v_quality": """
SELECT t.sample, l_returnflag || l_linestatus AS tool, CASE WHEN SUM(l_partkey) % 19 = 0 THEN NULL ELSE CAST(SUM(l_partkey) % 1000 AS DOUBLE) / 1000 END AS f1,
       CASE WHEN SUM(l_partkey) % 19 = 0 THEN NULL ELSE CAST(SUM(l_suppkey * l_linenumber) % 1000 AS DOUBLE) / 1000 END AS precision, CAST(SUM(l_partkey * l_linenumber) % 1000 AS DOUBLE) / 1000 AS recall,
       CASE WHEN SUM(l_orderkey) % 5 > 0 THEN CAST(SUM(l_orderkey) % 7 AS DOUBLE) / 7 END AS plasmid_recall, CASE WHEN SUM(l_orderkey) % 4 > 0 THEN CAST(SUM(l_orderkey) % 1000 AS DOUBLE) / 1000 END AS bin_f1, CAST(NULL AS DOUBLE) AS amr_gene_recall,
       CAST(SUM(l_linenumber) % 3 AS DOUBLE) AS split_events, CAST(SUM(l_linenumber) % 2 AS DOUBLE) / 4 AS merge_events, CAST(SUM(l_suppkey) % 100 AS DOUBLE) / 200 AS contamination_fraction,
       CAST(SUM(l_quantity) AS DOUBLE) AS ambiguous_bp, CAST(SUM(l_quantity) * 6 AS DOUBLE) AS true_bp, CAST(COUNT(*) % 5 AS DOUBLE) AS excess_records, CAST(COUNT(*) % 9 AS DOUBLE) AS true_count
FROM lineitem JOIN v_truth t ON l_suppkey = t.sequence_id
GROUP BY t.sample, l_returnflag || l_linestatus""",
    "v_isolate": """
SELECT s.sample, 'species ' || species AS organism, CASE WHEN species % 2 = 0 THEN 'negative' ELSE 'positive' END AS gram_group, CASE WHEN study % 4 = 0 THEN NULL WHEN study % 4 = 1 THEN 'hybrid' ELSE 'long' END AS truth_technology,
       CASE study % 3 WHEN 0 THEN 'clinical' WHEN 1 THEN 'animal' ELSE 'environment' END AS sample_origin, n_name AS collection_country, CASE WHEN largest IS NULL THEN NULL WHEN largest >= 45000 THEN 'large' WHEN largest >= 35000 THEN 'medium' ELSE 'small' END AS plasmid_size_band,
       CASE WHEN coalesce(n, 0) > 3 THEN 'many' WHEN coalesce(n, 0) > 0 THEN 'few' ELSE 'none' END AS plasmid_count_band, CASE WHEN depth >= 26 THEN 'deep' ELSE 'shallow' END AS read_depth_band, CASE WHEN genes > 0 THEN 'positive' ELSE 'negative' END AS amr_status,
       CASE WHEN region < 2 THEN 'short_read' ELSE 'long_read' END AS analysis_track, CASE WHEN s.sample % 3 = 0 THEN 'q20' ELSE 'q30' END AS read_quality_band
FROM v_sheet s JOIN nation ON n_nationkey = s.sample LEFT JOIN (SELECT sample, max(length) AS largest, count(*) AS n FROM v_truth WHERE molecule_type = 'PLASMID' GROUP BY sample) t ON t.sample = s.sample
LEFT JOIN (SELECT sample, avg(depth) AS depth FROM v_contig GROUP BY sample) c ON c.sample = s.sample LEFT JOIN (SELECT sample, count(*) AS genes FROM v_gene GROUP BY sample) g ON g.sample = s.sample""",
    "v_status": """
SELECT t.sample, l_returnflag || l_linestatus AS tool,
       CASE WHEN SUM(l_partkey) % 19 = 0 THEN 'failed' WHEN SUM(l_partkey) % 19 = 1 THEN 'skipped' ELSE 'completed' END AS status,
       CASE WHEN SUM(l_partkey) % 19 = 0 THEN CASE WHEN SUM(l_orderkey) % 2 = 0 THEN 137 ELSE 1 END END AS exit_code,
       CAST(SUM(l_orderkey) % 5000 AS BIGINT) AS runtime_seconds, COUNT(*) AS size
FROM lineitem JOIN v_truth t ON l_suppkey = t.sequence_id
GROUP BY t.sample, l_returnflag || l_linestatus""",
    "v_edges": """
SELECT DISTINCT o_custkey AS a, (o_custkey * 7 + o_orderkey) % (SELECT COUNT(*) FROM customer) AS b FROM orders WHERE o_orderkey % 9 = 0""",
    "v_class": """
SELECT d.doc_id AS contig_id, d.doc_id % 5 AS community_id,
       CASE d.lang WHEN 'en' THEN 'plasmid' WHEN 'fr' THEN 'chromosome' ELSE 'virus' END AS truth_class,
       CASE WHEN l.quality = 1 THEN 'plasmid' WHEN l.toxic = 1 THEN 'virus' WHEN l.quality = 0 THEN 'chromosome' END AS predicted_class
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
}
_SEQ = """
SELECT doc_id AS id, source, translate(regexp_replace(lower(text), '[^a-z]', ''{global_}),
       'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS sequence FROM documents"""
_READS = """
SELECT conv_id % 5 AS sample, conv_id * 100 + turn // 2 AS pair, CAST(turn % 2 + 1 AS INT) AS mate, translate(letters, 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTNCGTACGTAC') AS seq,
       translate(letters, 'abcdefghijklmnopqrstuvwxyz', 'IHGFEDCBA@?>=<;:9876543210') AS qual FROM (SELECT conv_id, turn, regexp_replace(lower(text), '[^a-z]', ''{global_}) AS letters FROM conversations) WHERE letters <> ''"""
SPARK_TEXTS = TEXTS | {
    "v_reads": _READS.replace("{global_}", "").replace("turn // 2", "turn div 2"),
    "v_seq": _SEQ.replace("{global_}", ""),
    "v_depth": "SELECT user_id AS replicon, CAST(floor(unix_micros(CAST(ts AS TIMESTAMP)) / 60000000) AS BIGINT) - 28401120 AS pos, value AS depth FROM events",
}
DUCK_TEXTS = TEXTS | {
    "v_reads": _READS.replace("{global_}", ", 'g'"),
    "v_seq": _SEQ.replace("{global_}", ", 'g'"),
    "v_depth": "SELECT user_id AS replicon, CAST(floor(epoch(ts) / 60) AS BIGINT) - 28401120 AS pos, value AS depth FROM events",
}


def needs(text: str) -> list[str]:
    """Views and tables that a text reads."""
    return [w for w in dict.fromkeys(re.findall(r"(?:FROM|JOIN)\s+(\w+)", text)) if w in DUCK_TEXTS or w in TABLES]


class Views:
    """Tables of one folder and the views over them, each read when first asked for: Views(spark, dir).v_truth."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        elif name in SPARK_TEXTS:
            df = self.sql(SPARK_TEXTS[name])
        else:
            raise AttributeError(name)
        self.__dict__[name] = df
        return df

    def sql(self, text: str) -> DataFrame:
        # row counts of dimensions become constants: a scalar subquery inside a join's condition may not have run when the join needs it
        text = re.sub(r"\(SELECT COUNT\(\*\) FROM (\w+)\)", lambda m: str(getattr(self, m[1]).count()), text)
        used = needs(text)
        for name in used:
            text = re.sub(rf"\b((?:FROM|JOIN)\s+){name}\b", rf"\1{{{name}}}", text)
        return self.spark.sql(text, **{name: getattr(self, name) for name in used})

    @cached_property
    def retained(self) -> DataFrame:
        from tessera.operators import scoring

        return scoring.retain(self.v_aln)


#: Alignments that pass the default filters, clipped to their target, as DuckDB text.
DUCK_TEXTS["v_retained"] = """
SELECT *, greatest(0, least(tstart, tend)) AS s, least(tlen, greatest(tstart, tend)) AS e FROM v_aln
WHERE is_primary AND block_length >= 200 AND qlen > 0 AND CAST(matches AS DOUBLE) / block_length >= 0.9
  AND mapq >= 20 AND CAST(abs(qend - qstart) AS DOUBLE) / qlen >= 0.2"""


DUCK_TEXTS["v_mapped_retained"] = DUCK_TEXTS["v_retained"].replace("v_aln", "v_mapped")


def islands_text(name: str, source: str, keys: str, s: str = "s", e: str = "e") -> str:
    """CTEs that end in ``name``: the merged intervals (keys, s, e) of source."""
    return f"""
{name}_1 AS (SELECT {keys}, {s} AS s, {e} AS e, max({e}) OVER (PARTITION BY {keys} ORDER BY {s}, {e} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source}),
{name}_2 AS (SELECT {keys}, s, e, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM {name}_1),
{name} AS (SELECT {keys}, min(s) AS s, max(e) AS e FROM {name}_2 GROUP BY {keys}, island)"""


def duck(sql: str, ctes: str = "") -> str:
    """A whole DuckDB statement: the views that the texts read, further CTEs, and the final SELECT."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in needs(text):
            if name in DUCK_TEXTS and name not in order:
                visit(DUCK_TEXTS[name])
                order.append(name)

    visit(ctes + " " + sql)
    parts = [f"{name} AS ({DUCK_TEXTS[name]})" for name in order] + ([ctes.strip()] if ctes.strip() else [])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql
