"""Small inputs for the unit tests."""

from datetime import date, datetime, timezone

from lodeworks.plans.silver import build_silver

AS_OF = date(2024, 6, 30)
RUN_TS = datetime(2024, 7, 1, tzinfo=timezone.utc)


def bronze(spark, contract, *records):
    """Bronze rows from dictionaries; columns not given are NULL."""
    names = contract.bronze.fieldNames()
    return spark.createDataFrame(
        [tuple(record.get(name) for name in names) for record in records], contract.bronze
    )


def silver(spark, contract, *records, **options):
    options = {"as_of": AS_OF, "run_ts": RUN_TS, **options}
    return build_silver(bronze(spark, contract, *records), contract, **options)


def values(df, *names):
    """Rows as tuples in a stable order."""
    return sorted((tuple(row) for row in df.select(*names).collect()), key=repr)
