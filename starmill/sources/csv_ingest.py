"""CSV files into the raw layer: manifest check, type inference, rebuild and summary."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.calendar import iso_utc, timestamp_literal
from starmill.functions.columns import quoted
from starmill.session import side_by_side
from starmill.sources.files import exists
from starmill.sources.layers import Layer

# The files an ingest run expects.
MANIFEST = [
    "dim_campaigns.csv",
    "dim_customers.csv",
    "dim_dates.csv",
    "dim_products.csv",
    "dim_salespersons.csv",
    "dim_stores.csv",
    "fact_sales_denormalized.csv",
    "fact_sales_normalized.csv",
]

#: Lines at the beginning of a file that its types are inferred from.
SAMPLE_LINES = 20_000


def first_existing(spark: SparkSession, sources: Sequence[str]) -> str:
    """The first source folder that exists, for example the full data before the sample."""
    for source in sources:
        if exists(spark, source):
            return source.rstrip("/")
    raise FileNotFoundError(f"no source folder among {list(sources)}")


def require_files(spark: SparkSession, folder: str, manifest: Iterable[str]) -> None:
    """Raise with every missing file, before anything is loaded."""
    missing = [f"{folder}/{name}" for name in manifest if not exists(spark, f"{folder}/{name}")]
    if missing:
        raise FileNotFoundError("missing CSV files:\n" + "\n".join(missing))


def _reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("escape", '"').option("mode", "FAILFAST").option("enforceSchema", False)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """A CSV file (or folder of part files) with a header.

    Without a schema the types are inferred from all rows, which costs one more pass over the file;
    ``sampled_csv`` spares it. Bad rows raise instead of turning into NULLs. ``multi_line`` is
    for quoted line breaks and makes a file unsplittable, so it is off unless asked for.
    """
    reader = _reader(spark).option("header", True).option("multiLine", multi_line)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return widened(reader.option("inferSchema", True).csv(path))


def widened(df: DataFrame) -> DataFrame:
    """Inferred integers as bigint and inferred timestamps without a zone."""
    targets = {T.IntegerType(): "bigint", T.TimestampType(): "timestamp_ntz"}
    return df.select(
        *[
            quoted(f.name).cast(targets[f.dataType]).alias(f.name) if f.dataType in targets
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def sampled_types(spark: SparkSession, path: str, lines: int = SAMPLE_LINES) -> T.StructType:
    """The columns of a CSV file with a header, their types inferred from its first lines.

    Whole numbers are bigint, timestamps have no zone, columns without a value in those lines are text.
    """
    names = _reader(spark).option("header", True).csv(path).columns
    # A bounded number of lines, from as few partitions as have them.
    head = [row.value for row in spark.read.text(path).take(lines + 1)]
    body = [line for line in head[1:] if line != head[0]]
    if not body:
        return T.StructType([T.StructField(name, T.StringType()) for name in names])
    lines_of = spark.sparkContext.parallelize(body, 1)
    inferred = widened(_reader(spark).option("inferSchema", True).csv(lines_of)).schema
    texts = _reader(spark).schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv(lines_of)
    # Inference reads some texts as times of today, such as T1: a type must hold the sample's values.
    kinds = [f.dataType for f in inferred.fields]
    misfits = [F.count_if(quoted(n).isNotNull() & _fitted(quoted(n), kind).isNull()) for n, kind in zip(names, kinds, strict=True)]
    unfit = texts.agg(*[bad.alias(f"n{i}") for i, bad in enumerate(misfits)]).first()
    kinds = [T.StringType() if bad else kind for kind, bad in zip(kinds, unfit)]
    return T.StructType([T.StructField(n, kind) for n, kind in zip(names, kinds)])


def _fitted(text: Column, kind: T.DataType) -> Column:
    """A text as a value of a type, null where it is none."""
    if isinstance(kind, T.DateType):
        return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")
    if isinstance(kind, T.BooleanType):
        word = F.lower(text)
        return F.when(word.isin("true", "false"), word == "true")
    return text.try_cast(kind)


class SampledCsv:
    """A CSV file in types that its first lines suggest; every row is checked as it is read.

    ``df`` holds the typed rows. Whoever has written them all calls ``require_fit``: the one pass that
    writes also counts, for each column, the values that do not fit.
    """

    def __init__(self, spark: SparkSession, path: str, lines: int = SAMPLE_LINES) -> None:
        self.path, self.schema = path, sampled_types(spark, path, lines)
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in self.schema.fields])
        read = read_csv(spark, path, texts)
        values = [(quoted(f.name), _fitted(quoted(f.name), f.dataType)) for f in self.schema.fields]
        misfit = [text.isNotNull() & value.isNull() for text, value in values]
        self._found = Observation()
        watched = read.observe(
            self._found,
            *[F.count_if(bad).alias(f"n{i}") for i, bad in enumerate(misfit)],
            *[F.min(F.when(bad, values[i][0])).alias(f"least{i}") for i, bad in enumerate(misfit)],
        )
        self.df = watched.select(*[v.alias(f.name) for (_, v), f in zip(values, self.schema.fields)])

    def misfits(self) -> dict[str, tuple[int, str]]:
        """Number and least text of the values that fit no type, by column, once the rows were written."""
        found = self._found.get
        numbered = enumerate(self.schema.fields)
        return {f.name: (found[f"n{i}"], found[f"least{i}"]) for i, f in numbered if found[f"n{i}"]}

    def require_fit(self) -> None:
        kinds = {f.name: f.dataType.simpleString() for f in self.schema.fields}
        said = [f"{n} values of {c} are no {kinds[c]}, such as {text!r}" for c, (n, text) in self.misfits().items()]
        if said:
            raise ValueError(f"{self.path}: " + "; ".join(said) + "; give schemas= for this file")


def ingest(
    raw: Layer,
    sources: Sequence[str],
    manifest: Sequence[str] = MANIFEST,
    schemas: Mapping[str, T.StructType] | None = None,
) -> str:
    """Rebuild one raw table per CSV file; returns the source folder used.

    A file is read once, but for its first lines. A value that does not fit its column's type raises, and
    the table stays as it was.
    """
    folder = first_existing(raw.spark, sources)
    require_files(raw.spark, folder, manifest)

    def load(name: str) -> DataFrame:
        table, path = name.removesuffix(".csv"), f"{folder}/{name}"
        schema = (schemas or {}).get(table)
        if schema is not None:
            return raw.replace(table, read_csv(raw.spark, path, schema))
        sampled = SampledCsv(raw.spark, path)
        return raw.replace(table, sampled.df, verify=sampled.require_fit)

    side_by_side({name: partial(load, name) for name in manifest})
    return folder


def ingest_summary(raw: Layer, manifest: Sequence[str] = MANIFEST) -> DataFrame:
    """(file, table, rows, columns) per ingested file, counted from the Parquet footers."""
    parts = []
    for name in manifest:
        stored = raw.read(name.removesuffix(".csv"))
        parts.append(
            stored.agg(F.count("*").alias("rows")).select(
                F.lit(name).alias("file"),
                F.lit(f"{raw.name}.{name.removesuffix('.csv')}").alias("table"),
                "rows",
                F.lit(len(stored.columns)).cast("bigint").alias("columns"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def write_ingest_summary(
    summary: DataFrame, path: str, run_ts: datetime, raw_dir: str, db_path: str
) -> None:
    """The summary as one JSON document; it has one entry per file of the manifest."""
    entry = F.struct("file", "table", "rows", "columns")
    document = summary.agg(F.array_sort(F.collect_list(entry)).alias("tables")).select(
        iso_utc(timestamp_literal(run_ts)).alias("run_utc"),
        F.lit(raw_dir).alias("raw_dir"),
        F.lit(db_path).alias("db_path"),
        "tables",
    )
    document.write.mode("overwrite").json(path)
