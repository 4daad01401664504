"""Where the 19 application tables come from (SRC-01..SRC-19).

A ``Sources`` object maps a source name (``"Business"``, ``"ChangeLog"``, ...)
to a DataFrame with the source's camelCase columns. Models only call
``table(name)``; filters and projections they apply afterwards are pushed into
the scan by Catalyst (ChangeLog is always read with its two equality
predicates, so a table partitioned by ``entityType, fieldName`` is pruned).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from .adapters import ADAPTERS, render
from .schemas import declared

SOURCE_NAMES = (
    "Business", "Lead", "Policy", "Quote", "ApplicationSubmission", "User", "Opportunity",
    "PolicyTransaction", "Carrier", "ChangeLog", "OpportunityStatusHistory", "WarmTransfer",
    "CampaignStatus", "EmployeeContactInformation", "License", "Partner", "BusinessClassification",
    "RingbaCallLog", "RingbaCallEvent",
)


class Sources:
    """A name -> DataFrame lookup with the declared columns (``schemas``). Each table is
    opened, and its schema checked, once per build; a subclass says how it is read."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._tables: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def table(self, name: str) -> DataFrame:
        if name not in SOURCE_NAMES:
            raise KeyError(f"no source {name!r}")
        if name not in self._tables:
            self._tables[name] = declared(name, self.read(name))
        return self._tables[name]


class ParquetSources(Sources):
    """Each source is a Parquet dataset at ``<root>/<Name>`` (optionally partitioned)."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark)
        self.root = root.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")


class CatalogSources(Sources):
    """Each source is a metastore table ``<database>.<Name>``."""

    def __init__(self, spark: SparkSession, database: str):
        super().__init__(spark)
        self.database = database

    def read(self, name: str) -> DataFrame:
        return self.spark.table(f"`{self.database}`.`{name}`")


class JdbcSources(Sources):
    """Each source is a table of the application's own database, read over JDBC.

    Spark pushes column pruning and simple filters (the ChangeLog models'
    ``entityType`` / ``fieldName`` equalities) into the SQL it sends, so the
    database returns only the slice a model reads. A large table is read in
    parallel when ``partitioning`` names a numeric column and its bounds:
    ``{"PolicyTransaction": ("id", 0, 50_000_000, 64)}``."""

    def __init__(self, spark: SparkSession, url: str, schema: str, properties: dict[str, str],
                 partitioning: dict[str, tuple[str, int, int, int]] | None = None):
        super().__init__(spark)
        self.url, self.schema = url, schema
        self.properties, self.partitioning = dict(properties), dict(partitioning or {})

    def options(self, name: str) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": f'"{self.schema}"."{name}"', **self.properties}
        if name in self.partitioning:
            column, lower, upper, n = self.partitioning[name]
            opts.update(partitionColumn=f'"{column}"', lowerBound=str(lower), upperBound=str(upper),
                        numPartitions=str(n))
        return opts

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options(name)).load()


class DataFrameSources(Sources):
    """Sources given directly as DataFrames (tests, or tables already loaded)."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame]):
        super().__init__(spark)
        self.tables = dict(tables)

    def read(self, name: str) -> DataFrame:
        return self.tables[name]


class FixtureSources(Sources):
    """Sources derived from the driver's test tables (see ``adapters``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def read(self, name: str) -> DataFrame:
        inputs, _ = ADAPTERS[name]
        return self.spark.sql(render(name, "spark"), **{t: self.raw(t) for t in inputs})


# How production would lay out the application tables as files: the audit log
# is partitioned by what the status models filter on, so their two equality
# predicates become partition pruning instead of row-group skipping.
PRODUCTION_LAYOUT = {"ChangeLog": ("entityType", "fieldName")}


def materialize_sources(sources: Sources, root: str, names=SOURCE_NAMES,
                        records_per_file: int | None = None, parallel: int = 4,
                        partition_by: dict[str, tuple[str, ...]] | None = None) -> ParquetSources:
    """Write every source table once to Parquet under ``root`` and return a
    ``ParquetSources`` over the copies (used to stage derived test sources the
    way application tables already exist in production). Files are as large
    as Spark writes them; ``records_per_file`` caps them for small test data, so that
    its scans get more than one task. The tables are
    independent, so up to ``parallel`` are written at once as separate jobs.
    ``partition_by`` names partition columns per table (``PRODUCTION_LAYOUT``)."""
    def write(name: str, df: DataFrame) -> None:
        w = df.write.mode("errorifexists")
        if records_per_file:
            w = w.option("maxRecordsPerFile", records_per_file)
        if partition_by and name in partition_by:
            w = w.partitionBy(*partition_by[name])
        w.parquet(f"{root.rstrip('/')}/{name}")

    frames = {name: sources.table(name) for name in names}  # plans built on this thread
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for f in [pool.submit(write, n, df) for n, df in frames.items()]:
            f.result()
    return ParquetSources(sources.spark, root)
