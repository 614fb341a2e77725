"""Packages: many named outputs of one written table, and a manifest that is read back from the file system."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions import text
from postloom.sources import sinks

MANIFEST = "Name string, Purpose string, Format string, Exists boolean, Files long, SizeBytes long, Rows long"


@dataclass
class Output:
    """One file set of a package: how its rows come from the table, and what for."""

    name: str
    purpose: str
    rows: object
    format: str = "csv"


def shown(df: DataFrame) -> DataFrame:
    """Display text by the names of columns: percents with two digits, scores and counts whole, dates without a time, flags as Yes and No."""
    def cell(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind == "boolean":
            c = F.when(c, "Yes").otherwise("No")
        elif name.endswith(("Percent", "Rate")):
            c = F.concat(F.format_string("%.2f", c.cast("double")), F.lit("%"))
        elif kind in ("double", "float"):
            c = F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(F.regexp_replace(F.format_string("%.4f", c.cast("double")), "0+$", ""))
        elif kind in ("date", "timestamp"):
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind.startswith("array"):
            c = F.array_join(c, " | ")
        return F.coalesce(c.cast("string"), F.lit("")).alias(name)

    return df.select(*[cell(n, k) for n, k in df.dtypes])


def write_package(table: DataFrame, outputs: list[Output], root: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """Writes the table once and each output from it, formats in skip left out; the manifest of what is there."""
    spark = table.sparkSession
    table.write.mode("overwrite").parquet(f"{root}/_table")
    whole = spark.read.schema(table.schema).parquet(f"{root}/_table")
    for o in outputs:
        if o.format in skip:
            continue
        path = f"{root}/{o.name}"
        rows = o.rows(whole)
        if o.format == "csv":
            sinks.write_delimited(shown(rows), path)
        elif o.format == "json":
            sinks.write_json_lines(rows, path)
        else:
            rows.write.mode("overwrite").parquet(path)
    return manifest(spark, outputs, root)


def manifest(spark: SparkSession, outputs: list[Output], root: str) -> DataFrame:
    """What the file system has of each output: files, bytes and rows; a line for each, also for those that aren't there."""
    jvm = spark._jvm.org.apache.hadoop.fs
    fs, lines = jvm.Path(root).getFileSystem(spark._jsc.hadoopConfiguration()), []
    for o in outputs:
        path = f"{root}/{o.name}"
        exists = fs.exists(jvm.Path(f"{path}/_SUCCESS"))
        files = [s for s in fs.listStatus(jvm.Path(path)) if not s.getPath().getName().startswith(("_", "."))] if exists else []
        rows = None
        if exists:
            read = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path) if o.format == "csv" and files else spark.read.format("json" if o.format == "json" else "parquet").load(path) if files else None
            rows = read.count() if read is not None else 0
        lines.append((o.name, o.purpose, o.format, exists, len(files), sum(s.getLen() for s in files), rows))
    return spark.createDataFrame(lines, MANIFEST)


def missing(manifest_: DataFrame) -> Column | DataFrame:
    """The outputs that aren't there or are empty."""
    return manifest_.where("not Exists or SizeBytes = 0").select("Name", text.clean(F.col("Purpose")).alias("Purpose"))
