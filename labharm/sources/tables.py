"""Readers and writers with explicit schemas and explicit rules for what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labharm.operators.order import numbered

#: Schemas of the four extracts and of the vocabulary tables, as DDL.
_K5 = "OMOP_CONCEPT_ID int, TEST_NAME string, MEASUREMENT_UNIT_PREFIX string, MEASUREMENT_UNIT string, IS_EXTRACTED boolean"
SCHEMAS = {
    "summaryTest": f"{_K5}, MEASUREMENT_UNIT_HARMONIZED string, omopQuantity string, CONVERSION_FACTOR string, n_records int, n_subjects int",
    "summaryValuesSource": f"{_K5}, MEASUREMENT_VALUE_TYPE string, n_subjects int, n_records int",
    "summaryValues": f"{_K5}, n_subjects int, n_records int, decile double, decile_MEASUREMENT_VALUE double, decile_MEASUREMENT_VALUE_HARMONIZED double",
    "summaryOutcomes": f"{_K5}, TEST_OUTCOME string, n_TEST_OUTCOME int, n_subjects int",
    "unit_fix": "TEST_NAME_ABBREVIATION string, source_unit_clean string, source_unit_clean_fix string, notes string, validation_messages string",
    "unit_conversion": "omop_quantity string, source_unit_valid string, to_source_unit_valid string, conversion string, only_to_omop_concepts string, validation_messages string",
    "ignore_list": "TEST_NAME string, ORIGINAL_NAME string, MEASUREMENT_UNIT string, CATEGORY string, REASON string, HAD_LEADING_DASH string, ENGLISH_TRANSLATION string",
}


def read_tsv(spark: SparkSession, path: str, schema: str | T.StructType, na_text: bool = False, sep: str = "\t") -> DataFrame:
    """A delimited table with a header; only empty cells are null, with na_text the text NA is too. Missing paths fail at once."""
    options = {"sep": sep, "nullValue": "", "mode": "FAILFAST"}
    df = spark.read.schema(schema).options(header=True, **options).csv(path)
    df = df.unionByName(_blank(spark, path, df.schema, options))
    if na_text:
        df = df.select(*(F.nullif(F.col(f.name), F.lit("NA")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema))
    return df


def _blank(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """Rows of lines that hold nothing but white space and separators: where those are white space too, Spark's CSV reader takes such lines for empty ones and skips them."""
    if options["sep"].strip():
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).filter(F.col("value").rlike(r"^[\x00-\x20]*$") & F.contains("value", F.lit(options["sep"])))
    return lines.select(F.from_csv("value", schema.toDDL(), options).alias("row")).select("row.*")


def read_extracts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_tsv(spark, f"{folder}/{name}.tsv", SCHEMAS[name]) for name in ("summaryTest", "summaryValuesSource", "summaryValues", "summaryOutcomes")}


def read_unit_fix(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, SCHEMAS["unit_fix"], na_text=True)


def read_unit_conversion(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, SCHEMAS["unit_conversion"])


def read_ignore_list(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, SCHEMAS["ignore_list"], sep=";")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The mapping: all cells as text, then the columns that are used, typed, and line, the record's number (from 1) over all of the table's files in the order of their names."""
    raw = spark.read.option("header", True).option("nullValue", "").option("multiLine", True).option("escape", '"').csv(path)
    names = {"sourceCode": "sourceCode", "ADD_INFO:testNameAbbreviation": "testNameAbbreviation", "ADD_INFO:measurementUnit": "measurementUnit", "conceptName": "conceptName", "ADD_INFO:omopQuantity": "omopQuantity", "ADD_INFO:validationMessages": "validationMessages", "mappingStatus": "mappingStatus", "ADD_INFO:ignoreReason": "ignoreReason"}
    cells = [F.expr("try_cast(conceptId as int)").alias("conceptId"), *(F.col(f"`{c}`").alias(n) for c, n in names.items())]
    placed = raw.select(F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__row"), *cells)  # a file that spans lines is one task's
    return numbered(placed, [F.col("__file"), F.col("__row")], "line").drop("__file", "__row")


def text_to_parquet(spark: SparkSession, source: str, target: str) -> None:
    """Tab-separated raw text, gzipped or not, to Parquet: NA is null. Lines with too many or too few cells go, as they are, to a text table beside it, target-malformed."""
    options = {"sep": "\t", "nullValue": "NA", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__line"}
    read = spark.read.options(header=True, **options)
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in read.csv(source).columns), T.StructField("__line", T.StringType())])
    lines = read.schema(schema).csv(source)
    lines = lines.unionByName(_blank(spark, source, schema, options)).select(*schema.names)
    lines.filter("__line is null").drop("__line").write.parquet(target)
    lines.filter("__line is not null").select(F.coalesce("__line", *schema.names[:-1]).alias("value")).write.text(f"{target}-malformed")


def vocabulary_views(spark: SparkSession, folder: str, schemas: dict[str, str]) -> None:
    """A view for each tab-separated file (name.csv) of a vocabulary folder, with the given schemas."""
    for name, schema in schemas.items():
        read_tsv(spark, f"{folder}/{name}.csv", schema).createOrReplaceTempView(name)


def _csv(df: DataFrame):
    """Cells as they are: the writer would strip their spaces."""
    return df.write.option("header", True).option("nullValue", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)


def write_csv(df: DataFrame, path: str) -> None:
    """Comma-separated, missing values as empty cells, quotes doubled, to a path that isn't there yet."""
    _csv(df).option("escape", '"').csv(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text (a status) as a text table of one part."""
    spark.createDataFrame([(line,) for line in text.split("\n")], "value string").coalesce(1).write.text(path)


def write_tsv(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Missing values are empty cells; to a path that isn't there yet."""
    _csv(df).option("sep", sep).csv(path)


def _beside(path: str) -> tuple[str, str]:
    return f"{path.rstrip('/')}.__new", f"{path.rstrip('/')}.__old"


def _files(spark: SparkSession, path: str):
    """The path's file system, by which Spark itself reads it, and a maker of its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def recover(spark: SparkSession, path: str) -> None:
    """Ends what a job that died within `replace_csv` left: a swap that had begun is completed, a table that was only being written goes."""
    (new, old), (fs, at) = _beside(path), _files(spark, path)
    if not fs.exists(at(path)) and fs.exists(at(old)):  # it died between the two renames: the new table was complete
        fs.rename(at(new) if fs.exists(at(new)) else at(old), at(path))
    for left in (new, old):
        if fs.exists(at(left)):
            fs.delete(at(left), True)


def replace_csv(df: DataFrame, path: str, key: list[str] | None = None) -> None:
    """Puts df in the place of the table at path, from which it may itself be read.

    df is written beside the table and checked there (as many rows as were written, and, with key, none of its keys twice); only then do the old and the new table change
    places. A reader finds either of them whole, but for the moment between two renames; if the job dies there or before, `recover` (which each call begins with) ends it.
    """
    spark = df.sparkSession
    recover(spark, path)
    (new, old), (fs, at) = _beside(path), _files(spark, path)
    seen = Observation()
    write_csv(df.observe(seen, F.count(F.lit(1)).alias("n")), new)
    there = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(new)
    n = there.count()
    twice = there.groupBy(*key).count().filter("count > 1").limit(1).count() if key else 0
    if n != seen.get["n"] or twice:
        fs.delete(at(new), True)
        raise ValueError(f"{path} stays as it was: {seen.get['n']} rows were written and {n} read again" + (", keys are there twice" if twice else ""))
    if fs.exists(at(path)):
        fs.rename(at(path), at(old))
    fs.rename(at(new), at(path))
    fs.delete(at(old), True)
