"""Station climate tables: ``;``-separated latin-1 text, plain or zipped."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmill.functions.columns import quoted
from gridmill.schemas import weather_parameter
from gridmill.sources import archives

ENCODING = "ISO-8859-1"
SEPARATOR = ";"
STAMP = "MESS_DATUM"
TEXT_COLUMNS = ("STATIONS_ID", "MESS_DATUM", "eor", "MESS_DATUM_WOZ", "V_N_I")


def member_pattern(parameter: str, station: str | None = None) -> str:
    """Name of the data member in a station archive."""
    weather_parameter(parameter)
    return f"produkt_{parameter.lower()}_stunde_.*_{station or '.*'}.txt"


def read_climate_text(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """Plain text tables; the header line of each file names its columns, in whatever order.

    Files are grouped by header line, of which a parameter has a handful. With
    ``columns`` all files must have exactly these, in this order: others fail.
    """
    def read(names: list[str], files: str | list[str]) -> DataFrame:
        return (
            spark.read.option("sep", SEPARATOR).option("encoding", ENCODING).option("header", "true")
            .option("ignoreLeadingWhiteSpace", "true").option("ignoreTrailingWhiteSpace", "true").option("enforceSchema", "false")
            .schema(", ".join(f"`{c}` string" for c in names)).csv(files)
        )

    if columns:
        return _typed(read(columns, paths))
    first = F.split(F.col("value"), SEPARATOR)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
    headers = (lines.filter(F.array_contains(F.transform(first, lambda x: F.trim(x)), STAMP))
               .groupBy("value").agg(F.collect_set("file").alias("files")).orderBy("value").collect())
    if not headers:
        raise ValueError(f"no header line with {STAMP} in {paths}")
    parts = []
    for row in headers:
        names = [n.strip() for n in row["value"].split(SEPARATOR)]
        parts.append(read(names, [unquote(f) for f in row["files"]]))
    return _typed(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))


def read_climate_archives(spark: SparkSession, paths: str | list[str], parameter: str,
                          station: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Zipped tables, one archive per station. Columns are found by name; ``columns`` saves the pass over the headers."""
    files = archives.archives(spark, paths)
    member = member_pattern(parameter, station)
    if columns:
        return _typed(archives.csv_rows(files, member, columns, ENCODING, SEPARATOR))
    # Column names of one parameter: a handful, however many archives there are.
    names = (archives.csv_headers(files, member, ENCODING)
             .select(F.posexplode(F.split("header", SEPARATOR)).alias("place", "name"))
             .select("place", F.trim("name").alias("name"))
             .groupBy("name").agg(F.min("place").alias("place")).orderBy("place", "name"))
    columns = [r["name"] for r in names.collect() if r["name"]]
    return _typed(archives.csv_rows(files, member, columns, ENCODING, SEPARATOR))


def _typed(df: DataFrame) -> DataFrame:
    """Measurement columns as numbers, ids and stamps as they are."""
    out = []
    for c in df.columns:
        if c == "STATIONS_ID":
            out.append(quoted(c).try_cast("int").alias(c))
        elif c in TEXT_COLUMNS:
            out.append(quoted(c))
        else:
            out.append(quoted(c).try_cast("double").alias(c))
    return df.select(*out)
