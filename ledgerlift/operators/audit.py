"""Load reconciliation and cleanup audits."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.functions.text import keep_code_page


def reconcile(entity: str, extracted: DataFrame, loaded: DataFrame, rejected: DataFrame) -> DataFrame:
    """Row counts of one load and whether extracted = loaded + rejected."""
    stages = {"extracted": extracted, "loaded": loaded, "rejected": rejected}
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.count("*").alias("n")).withColumn("stage", F.lit(s)) for s, df in stages.items()],
    )
    return (
        counts.groupBy(F.lit(entity).alias("entity"))
        .agg(*(F.sum(F.when(F.col("stage") == s, F.col("n"))).alias(s) for s in stages))
        .withColumn("balanced", F.col("extracted") == F.col("loaded") + F.col("rejected"))
    )


def cleanup_audit(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Rows and characters that cleanup takes out, per column and ``by``; one pass for all columns."""
    removed = {c: F.length(c) - F.length(keep_code_page(F.col(c))) for c in columns}
    counted = df.select(F.col(by), *(r.alias(f"_r_{c}") for c, r in removed.items())).groupBy(by).agg(*(
        F.struct(
            F.count_if(F.col(f"_r_{c}") > 0).alias("changed_rows"),
            F.coalesce(F.sum(f"_r_{c}"), F.lit(0)).cast("bigint").alias("removed_chars"),
            F.lit(c).alias("column_name"),
        ).alias(f"_a_{c}")
        for c in columns
    ))
    return counted.select(F.col(by), F.explode(F.array(*(F.col(f"_a_{c}") for c in columns))).alias("a")).select(by, "a.*")
