"""Leakage by date: what a tool's database could have held when it was released."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tolerant_date(text):
    """A date of a text like 2019-03-07, 2019-03 or 2019 (its first day); null for others."""
    day = F.regexp_extract(F.trim(text), r"^(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?(?:T.*)?$", 1)
    month, date = (F.regexp_extract(F.trim(text), r"^(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?(?:T.*)?$", k) for k in (2, 3))
    full = F.concat_ws("-", day, F.when(month == "", "01").otherwise(month), F.when(date == "", "01").otherwise(date))
    return F.when(day != "", F.try_to_timestamp(full, F.lit("yyyy-MM-dd")).cast("date"))


def in_force(runs: DataFrame, releases: DataFrame) -> DataFrame:
    """runs with the newest release of their tool that was out when they ran (release, db_date; null if none was): an as-of join by equality alone.

    Releases are gathered by tool and year. A run takes the last one of its own year that was out, or else the last of an earlier year.
    """
    cells = releases.withColumn("year", F.year("released"))
    last = cells.groupBy("tool", "year").agg(F.max(F.struct("released", "release", "db_date")).alias("newest"), F.array_sort(F.collect_set(F.struct("released", "release", "db_date"))).alias("all"))
    spread = runs.select("sample", "tool", "ran", F.year("ran").alias("year"))
    own = spread.join(last.select("tool", "year", "all"), ["tool", "year"], "left").withColumn("own", F.array_max(F.filter("all", lambda r: r["released"] <= F.col("ran"))))
    years = last.groupBy("tool").agg(F.array_sort(F.collect_list(F.struct("year", "newest"))).alias("years"))  # a row a year
    both = own.join(years, "tool", "left").withColumn("earlier", F.array_max(F.filter("years", lambda y: y["year"] < F.col("year")))["newest"])
    best = F.coalesce("own", "earlier")
    return both.select("sample", "tool", "ran", best["release"].alias("release"), best["db_date"].alias("db_date"))


def overlap_class(truth_date, uses_database, db_date):
    """Whether a sample could have been in a database: after_database only if the truth is younger; equal days may overlap; unknown without a date."""
    return F.when(~uses_database, "no_reference_database").when(truth_date.isNull() | db_date.isNull(), "unknown").when(truth_date <= db_date, "possible_overlap").otherwise("after_database")
