"""Rules that sort rows into good, bad and undecided, and the quarantine of bad rows.

SQL conditions have three outcomes. A row whose condition is NULL meets neither the bad nor the good rule; it is kept as undecided.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import fixed

GOOD, BAD, UNDECIDED = "good", "bad", "undecided"


class Rule(NamedTuple):
    bad: Column
    good: Column


def sales_rule() -> Rule:
    quantity, price = F.col("quantity"), F.col("unit_price")
    return Rule(bad=(quantity < 0) | (price < 0), good=(quantity >= 0) & (price >= 0))


def weblog_rule() -> Rule:
    ip = F.col("client_ip")
    return Rule(bad=ip == fixed.BAD_IP, good=ip != fixed.BAD_IP)


def lead_rule() -> Rule:
    score, email, company = F.col("lead_score"), F.col("email"), F.col("company_name")
    addressed = email.contains("@")
    named = company.isNotNull() & (F.trim(company) != "")
    return Rule(bad=(score < 0) | ~addressed | ~named, good=(score >= 0) & addressed & named)


def with_verdict(df: DataFrame, rule: Rule, name: str = "verdict") -> DataFrame:
    """One pass over `df`: each row gets its verdict, so a later write partitioned by it serves all three outcomes."""
    return df.withColumn(name, F.when(rule.bad, BAD).when(rule.good, GOOD).otherwise(UNDECIDED))


def split(df: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(good, bad, undecided): disjoint, and together all rows of `df`."""
    judged = with_verdict(df, rule, "_verdict")
    return tuple(judged.filter(F.col("_verdict") == v).drop("_verdict") for v in (GOOD, BAD, UNDECIDED))


def quarantine(df: DataFrame, source: str, reason: str, batch_id: int, job_name: str = fixed.LOAD_NAME) -> DataFrame:
    """Rejected rows as quarantine records: where from, why, and the whole row as JSON (NULL fields left out)."""
    return df.select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(job_name).alias("job_name"),
        F.lit(source).alias("source_name"),
        F.lit(reason).alias("error_reason"),
        F.to_json(F.struct("*")).alias("raw_record"),
    )


def rejected_fields(records: DataFrame, fields: StructType, source: str | None = None) -> DataFrame:
    """The columns of `records` (read with `record`, a variant) and, beside them, fields of the rejected rows in the types given.

    A field that a row lacks, that is NULL or does not convert is NULL, as is every field of text that is no JSON. Numbers and times in
    a variant keep their type, so a filter on them compares values and not text.
    """
    rows = records if source is None else records.filter(F.col("source_name") == source)
    found = [F.try_variant_get("record", f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in fields]
    return rows.select(*[c for c in rows.columns if c != "record"], *found)


def reject_reasons(records: DataFrame, field: str) -> DataFrame:
    """Rejected rows of each source and value of one field, whatever type it has there; NULL for rows without it."""
    value = F.try_variant_get("record", f"$['{field}']", "string").alias(field)
    return records.groupBy("source_name", value).agg(F.count("*").alias("rejected"))


def union_rejects(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejects per source, and in total (source NULL). Counts are formed before the shuffle, so a hot source is no burden."""
    return rejects.rollup("source_name").agg(F.count("*").alias("rejected"))
