"""Loading ledgers that may hold rows that cannot be read: good rows load, bad ones are listed with the reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.sources import schemas, seeds
from ledgerloom.sources.tables import RawTables, sound_cast

REJECTED = "ledger string, file string, reason string, record string"
_BAD = "_unreadable"
_WHY = "_reason"
# Every value is read as text, so that each can be judged; a row of another number of values is kept whole.
_CSV = {
    "header": "true",
    "enforceSchema": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _BAD,
    "columnPruning": "false",
}


def _arriving(spark: SparkSession, where: str, name: str, fmt: str, schema: StructType) -> DataFrame:
    if fmt == "csv":
        text = [StructField(field.name, StringType()) for field in schema]
        whole = StructType([*text, StructField(_BAD, StringType())])
        return spark.read.options(**_CSV).schema(whole).csv(f"{where}/{name}.csv")
    stored = spark.table(f"{where}.{name}") if fmt == "table" else spark.read.load(f"{where}/{name}", fmt)
    return stored.select(*schema.fieldNames()).withColumn(_BAD, F.lit(None).cast("string"))


def separated(table: DataFrame, schema: StructType, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose values all fit `schema`, typed; and the others, as REJECTED.

    Both are lazy scans of the same rows: one keeps where there is no reason, the other where there is one. The
    reason names the first column whose value does not fit. Missing values fit every column.
    """
    reasons: list[Column] = [F.when(F.col(_BAD).isNotNull(), "another number of values than columns")]
    columns = []
    for field in schema:
        value, arriving = F.col(field.name), table.schema[field.name].dataType
        cast, sound = sound_cast(value, arriving, field.dataType)
        said = F.concat(F.lit(f"{field.name} cannot be {field.dataType.simpleString()}: "), value.cast("string"))
        reasons.append(F.when(value.isNotNull() & ~sound, said))
        columns.append(cast.alias(field.name))
    judged = table.withColumns({_WHY: F.coalesce(*reasons), "_file": F.input_file_name()})
    record = F.coalesce(F.col(_BAD), F.to_json(F.struct(*schema.fieldNames())))
    rejected = judged.where(F.col(_WHY).isNotNull()).select(
        F.lit(name).alias("ledger"),
        F.nullif(F.col("_file"), F.lit("")).alias("file"),
        F.col(_WHY).alias("reason"),
        record.alias("record"),
    )
    return judged.where(F.col(_WHY).isNull()).select(*columns), rejected


def read_separated(
    spark: SparkSession, location: str, name: str, fmt: str = "csv"
) -> tuple[DataFrame, DataFrame]:
    """One ledger or reference list: its readable rows, typed, and the others, as REJECTED."""
    schema = {**schemas.LEDGERS, **schemas.REFERENCE_LISTS}[name]
    return separated(_arriving(spark, location, name, fmt, schema), schema, name)


def load_quarantined(
    spark: SparkSession, location: str, fmt: str = "csv", reference_location: str | None = None
) -> tuple[RawTables, DataFrame]:
    """As `load`, but rows that cannot be read are left out and listed instead of stopping the query.

    The second result has the columns of REJECTED: ledger, file (none for formats that do not tell), reason
    and the row as it arrived. It is lazy; storing it before the ledgers are used keeps both from one state
    of the files. A file whose header is not that of its ledger still stops the query, as all its rows would go.
    """
    tables, rejected = {}, []
    places = dict.fromkeys(schemas.LEDGERS, location)
    if reference_location is not None:
        places |= dict.fromkeys(schemas.REFERENCE_LISTS, reference_location)
    for name, where in places.items():
        tables[name], bad = read_separated(spark, where, name, fmt)
        rejected.append(bad)
    raw = RawTables(
        accounts=tables["a_m"],
        customers=tables["c_m"],
        fees=tables["f_l"],
        transactions=tables["t_l"],
        branches=tables.get("branches", seeds.seed_branches(spark)),
        divisions=tables.get("divisions", seeds.seed_divisions(spark)),
    )
    return raw, reduce(DataFrame.unionByName, rejected)
