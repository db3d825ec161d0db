"""Reading the ledgers and publishing tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    CharType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    FractionalType,
    IntegralType,
    StringType,
    StructType,
    VarcharType,
)

from ledgerloom.sources import schemas, seeds

# A header that differs from the schema stops the load, as columns go by position.
_CSV = {"header": "true", "enforceSchema": "false", "mode": "FAILFAST"}


@dataclass(frozen=True)
class RawTables:
    """The six inputs. Field names describe them; `load` knows the arriving names."""

    accounts: DataFrame
    customers: DataFrame
    fees: DataFrame
    transactions: DataFrame
    branches: DataFrame
    divisions: DataFrame


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Typed CSV scan: no inference pass, and a malformed row stops the load."""
    return spark.read.options(**_CSV).schema(schema).csv(path)


# How far the written form of a binary number may lie from the decimal it stands for, relative to it.
_NOISE = {DoubleType(): 1e-12, FloatType(): 1e-7}


def _fits(value: Column, cast: Column, arriving: DataType, wanted: DataType) -> Column:
    """Whether a cast kept the whole value; binary fractions may be off by their own rounding."""
    if isinstance(wanted, StringType):
        # identifiers and codes: a fraction or a binary number has no one written form
        return F.lit(isinstance(arriving, (IntegralType, CharType, VarcharType)) or getattr(arriving, "scale", 1) == 0)
    if arriving in _NOISE and isinstance(wanted, DecimalType):
        near = F.abs(value) * _NOISE[arriving] + 1e-9
        return F.abs(value.cast("double") - cast.cast("double")) <= near
    if isinstance(wanted, DecimalType) and not isinstance(arriving, IntegralType):
        return value.try_cast("decimal(38,18)") == cast.cast("decimal(38,18)")
    if isinstance(wanted, IntegralType) and isinstance(arriving, FractionalType):
        return value == cast.cast(arriving)
    return F.lit(True)


def sound_cast(value: Column, arriving: DataType, wanted: DataType) -> tuple[Column, Column]:
    """The value in another type, and whether that type holds it whole; never raises."""
    if arriving == wanted:
        return value, F.lit(True)
    cast = value.try_cast(wanted)
    return cast, cast.isNotNull() & F.coalesce(_fits(value, cast, arriving, wanted), F.lit(False))


def conformed(table: DataFrame, schema: StructType, name: str) -> DataFrame:
    """The columns of `schema`, in its types. A value that a type cannot hold whole stops the query.

    Columns that arrive in the right type are passed on as they are.
    """
    columns = []
    for field in schema:
        value, arriving = F.col(field.name), table.schema[field.name].dataType
        if arriving != field.dataType:
            cast, sound = sound_cast(value, arriving, field.dataType)
            said = F.concat(
                F.lit(f"{name}.{field.name} cannot be {field.dataType.simpleString()}: "),
                value.cast("string"),
            )
            refused = F.raise_error(said).cast(field.dataType)
            value = F.when(value.isNull() | sound, cast).otherwise(refused)
        columns.append(value.alias(field.name))
    return table.select(*columns)


def _read(spark: SparkSession, where: str, name: str, fmt: str, schema: StructType) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, f"{where}/{name}.csv", schema)
    stored = spark.table(f"{where}.{name}") if fmt == "table" else spark.read.load(f"{where}/{name}", fmt)
    return conformed(stored, schema, name)


def load_reference_lists(
    spark: SparkSession, location: str, fmt: str = "csv"
) -> tuple[DataFrame, DataFrame]:
    """Branches and divisions from `<location>/branches` and `<location>/divisions`, typed as in `load`."""
    branches, divisions = (
        _read(spark, location, name, fmt, schema) for name, schema in schemas.REFERENCE_LISTS.items()
    )
    return branches, divisions


def store_reference_lists(branches: DataFrame, divisions: DataFrame, location: str) -> None:
    """Write the two lists as CSV with a header, as `load_reference_lists` reads them.

    Columns are checked and cast first, so what is stored can be loaded.
    """
    lists = {"branches": branches, "divisions": divisions}
    for name, schema in schemas.REFERENCE_LISTS.items():
        table = conformed(lists[name], schema, name)
        table.write.option("header", "true").mode("overwrite").csv(f"{location}/{name}.csv")


def load(
    spark: SparkSession,
    location: str,
    fmt: str = "csv",
    reference_location: str | None = None,
) -> RawTables:
    """Read the ledgers from `location`.

    `csv` and other file formats expect `<location>/<table>` (a `.csv` suffix for
    csv); `table` expects catalog tables `<location>.<table>`. Branches and
    divisions come from `reference_location`, same layout, or from the built-in
    lists when it is left out. Whatever the format, columns come in the types of
    `schemas`; a value that does not fit, such as an amount finer than a cent,
    stops the query that reads it. Identifiers may arrive as whole numbers or as
    text and become text.
    """
    ledgers = {name: _read(spark, location, name, fmt, s) for name, s in schemas.LEDGERS.items()}
    if reference_location is None:
        branches, divisions = seeds.seed_branches(spark), seeds.seed_divisions(spark)
    else:
        branches, divisions = load_reference_lists(spark, reference_location, fmt)
    return RawTables(
        accounts=ledgers["a_m"],
        customers=ledgers["c_m"],
        fees=ledgers["f_l"],
        transactions=ledgers["t_l"],
        branches=branches,
        divisions=divisions,
    )


@dataclass(frozen=True)
class TableSink:
    """Full-refresh publishing: overwrite the table, hand back a scan of it.

    With `path` alone, tables are folders below it. With `namespace` (one or two
    parts, such as `workspace.finance`) they are catalog tables, stored below
    `path` if that is given too. A missing namespace is created.
    """

    fmt: str = "parquet"
    path: str | None = None
    namespace: str | None = None

    def __post_init__(self):
        if not (self.path or self.namespace):
            raise ValueError("a sink needs a path or a namespace")

    def publish(self, name: str, table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """Store a table, in a folder for each value of the columns `by` if there are any."""
        spark = table.sparkSession
        writer = table.write.format(self.fmt).mode("overwrite")
        if by:
            writer = writer.partitionBy(*by)
        if self.namespace:
            place = f" LOCATION '{self.path}'" if self.path else ""
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.namespace}{place}")
            if self.path:
                writer = writer.option("path", f"{self.path}/{name}")
            writer.saveAsTable(f"{self.namespace}.{name}")
            return spark.table(f"{self.namespace}.{name}").select(*table.columns)
        writer.save(f"{self.path}/{name}")
        stored = spark.read.format(self.fmt).schema(table.schema).load(f"{self.path}/{name}")
        return stored.select(*table.columns)

    def replace_parts(self, name: str, table: DataFrame, by: Sequence[str]) -> None:
        """Overwrite those folders of a table stored `by` columns that the given rows belong to, and no others."""
        if self.namespace:
            raise ValueError("parts are replaced in folders, not in catalog tables")
        writer = table.write.format(self.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*by).save(f"{self.path}/{name}")

    def stored(self, spark: SparkSession, name: str) -> DataFrame:
        """A scan of a table as it is now."""
        if self.namespace:
            return spark.table(f"{self.namespace}.{name}")
        return spark.read.format(self.fmt).load(f"{self.path}/{name}")

    def begin(self, spark: SparkSession) -> TableSink:
        """Where a refresh writes: in place."""
        return self

    def commit(self, spark: SparkSession, names: Iterable[str]) -> None:
        """Nothing is left to do: every table is visible once it is stored."""


def publish_view(name: str, table: DataFrame) -> DataFrame:
    """Session view instead of a stored table."""
    table.createOrReplaceTempView(name)
    return table.sparkSession.table(name)


_ENTRIES = "number bigint, folder string, tables array<string>"


@dataclass(frozen=True)
class VersionedSink:
    """Full-refresh publishing all at once: readers see the old tables until every new one is stored.

    Each refresh writes to a folder of its own below `path`. One row added to the list of versions
    publishes it: Spark commits that file or does not. A refresh that fails leaves no row, and the version
    before stays what `tables` reads. With `namespace`, views of that catalog schema follow the list; should
    a failure come between the two, `show` brings them in line. Old versions stay until they are removed
    by whoever owns the folder, so that running queries may finish.
    """

    path: str
    namespace: str | None = None
    fmt: str = "parquet"

    def versions(self, spark: SparkSession) -> DataFrame:
        """number, folder and tables of every published version."""
        place = f"{self.path}/versions"
        spark.createDataFrame([], _ENTRIES).write.mode("append").parquet(place)
        return spark.read.schema(_ENTRIES).parquet(place)

    def _latest(self, spark: SparkSession) -> Row | None:
        # of two refreshes that end together the last by name
        return self.versions(spark).orderBy(F.desc("number"), F.desc("folder")).first()

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Scans of all tables of the version that is published."""
        now = self._latest(spark)
        if now is None:
            return {}
        return {name: spark.read.format(self.fmt).load(f"{self.path}/{now.folder}/{name}") for name in now.tables}

    def begin(self, spark: SparkSession) -> _Version:
        return _Version(fmt=self.fmt, path=f"{self.path}/{uuid.uuid4().hex}", owner=self)

    def show(self, spark: SparkSession) -> None:
        """Point the views of `namespace` at the published version."""
        now = self._latest(spark)
        if now is None or not self.namespace:
            return
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.namespace}")
        for name in now.tables:
            stored = f"{self.fmt}.`{self.path}/{now.folder}/{name}`"
            spark.sql(f"CREATE OR REPLACE VIEW {self.namespace}.{name} AS SELECT * FROM {stored}")


@dataclass(frozen=True)
class _Version(TableSink):
    """The folder of one refresh."""

    owner: VersionedSink | None = None

    def commit(self, spark: SparkSession, names: Iterable[str]) -> None:
        before = self.owner._latest(spark)
        number = 1 if before is None else before.number + 1
        entry = [(number, self.path.rsplit("/", 1)[1], sorted(names))]
        spark.createDataFrame(entry, _ENTRIES).coalesce(1).write.mode("append").parquet(f"{self.owner.path}/versions")
        self.owner.show(spark)
