"""Bronze layer: raw tables as CSV and as partitioned Parquet, with a profile of each."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from shopmart.operators.contracts import RAW_CONTRACTS, check_columns, validate, with_violations
from shopmart.operators.profile import null_counts, profile_of_counts
from shopmart.schemas import RAW
from shopmart.session import freed_shuffles
from shopmart.sources import tables

#: Orders the rows of a raw table by delivery, where the feed stamps it; kept, but no part of a contract.
LOAD_SEQUENCE = "load_seq"


def ingest(
    spark: SparkSession, raw: dict[str, DataFrame], path: str, enforce_contracts: bool = True, quarantine: bool = False
) -> DataFrame:
    """Write raw tables as CSV under ``path`` and as Parquet under ``path/parquet``.

    Both forms come from the same frame, which is evaluated once for each; what is measured, rows
    that break the contract and the profile, is observed while writing. Every row must meet its
    table's contract: a table with others is not stored, and the old one stays. A feed with known
    faults is taken in whole with ``enforce_contracts=False``; the quality suite then reports on it.
    With ``quarantine`` its good rows are stored and the others, with the rules that they break, go to
    ``path/quarantine``. Returns one profile row per table.
    """
    counts: dict[str, Row] = {}

    def store(name: str) -> None:
        incoming = f"{path}/_incoming/{name}"
        frame = raw[name]
        if quarantine:
            frame = _without_bad(frame, name, incoming, f"{path}/quarantine/{name}")
        if enforce_contracts and not quarantine:
            _write_checked(frame, name, incoming, f"{path}/{name}")
        else:
            tables.write_csv(frame, f"{path}/{name}")
        declared = [c for c in RAW[name].fieldNames() if c in frame.columns]
        measured = Observation(f"profile-{name}")
        observed = frame.observe(measured, *map(F.expr, ["count(1) AS rows", *null_counts(frame.select(*declared))]))
        tables.write_dated(observed, f"{path}/parquet/{name}", name)
        counts[name] = Row(**measured.get)
        tables.remove(spark, incoming)

    with freed_shuffles(spark):
        tables.each(spark, raw, store)
    # One row a table.
    return reduce(DataFrame.unionByName, [
        profile_of_counts(
            spark.createDataFrame([counts[name]], ", ".join(f"`{c}` BIGINT" for c in counts[name].asDict())), name,
            [c.removeprefix("nulls_") for c in counts[name].asDict() if c != "rows"],
        )
        for name in raw
    ])


def _write_checked(frame: DataFrame, name: str, incoming: str, path: str) -> None:
    """Write the CSV beside the old one, counting rows off contract, and put it in place if there are none."""
    spark, contract = frame.sparkSession, RAW_CONTRACTS[name]
    check_columns(frame.drop(LOAD_SEQUENCE), contract)
    measured = Observation(f"contract-{name}")
    any_broken = " OR ".join(rule.broken() for rule in contract.rules)
    tables.write_csv(frame.observe(measured, F.expr(f"count_if({any_broken}) AS broken")), incoming)
    if measured.get["broken"]:
        tables.remove(spark, incoming)
        validate(frame.drop(LOAD_SEQUENCE), contract)  # raises, with examples
    tables.replace(spark, incoming, path)


def _without_bad(frame: DataFrame, name: str, incoming: str, quarantine: str) -> DataFrame:
    """Write rows by outcome in one pass, keep those off contract in quarantine, return the others."""
    spark = frame.sparkSession
    extra = [LOAD_SEQUENCE] if LOAD_SEQUENCE in frame.columns else []
    sorted_out = with_violations(frame, RAW_CONTRACTS[name], also=extra).withColumn("good", F.size("violations") == 0)
    sorted_out.write.mode("overwrite").partitionBy("good").parquet(incoming)
    stored = spark.read.schema(sorted_out.schema).parquet(incoming)
    stored.where("NOT good").drop("good").write.mode("overwrite").parquet(quarantine)
    return stored.where("good").drop("good", "violations")


def read(spark: SparkSession, path: str, layout: str = "parquet", keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The raw tables as ingested: the Parquet form, which prunes columns, or the CSV form.

    Of columns beyond the declared ones only those in ``keep`` come along, where they are stored.
    """
    if layout == "csv":
        return {name: tables.read_csv(spark, f"{path}/{name}", name) for name in RAW}
    found = {}
    for name, schema in RAW.items():
        stored = tables.read_parquet(spark, f"{path}/parquet/{name}")
        # Without the partition columns, which a scan appends.
        found[name] = stored.select(*schema.fieldNames(), *[c for c in keep if c in stored.columns])
    return found
