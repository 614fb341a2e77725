"""Writers: delimited text and JSON lines by slice, and a publisher that swaps a checked version in."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_text(df: DataFrame) -> DataFrame:
    """Booleans as TRUE and FALSE, arrays joined by pipes, the rest as strings, null as empty."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        c = F.when(c, "TRUE").otherwise("FALSE") if kind == "boolean" else F.array_join(c, " | ") if kind.startswith("array") else c.cast("string")
        out.append(F.coalesce(c, F.lit("")).alias(name))
    return df.select(*out)


def write_delimited(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = as_text(df).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "")
    (writer.partitionBy(by) if by else writer).csv(path)


def write_json_lines(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = df.write.mode("overwrite").option("ignoreNullFields", False)
    (writer.partitionBy(by) if by else writer).json(path)


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, least_rows: int = 1, required: dict[str, list[str]] | None = None) -> str:
    """Writes tables as a new version below root, checks them, and only then points to it.

    A pointer is a folder below root/latest whose name rises with time; it appears by one rename, and readers go by the
    last one. So there is a latest version at every moment, and a failure leaves the version before it in place.
    """
    version = f"v-{uuid.uuid4().hex}"
    fs, at = _files(spark, root)
    try:
        for name, df in tables.items():
            if missing := [c for c in (required or {}).get(name, []) if c not in df.columns]:
                raise ValueError(f"{name} is missing {', '.join(missing)}")
            df.write.parquet(f"{root}/{version}/{name}")
            if spark.read.schema(df.schema).parquet(f"{root}/{version}/{name}").limit(least_rows).count() < least_rows:
                raise ValueError(f"{name} has fewer than {least_rows} rows")
    except Exception:
        fs.delete(at(f"{root}/{version}"), True)
        raise
    spark.createDataFrame([(version, sorted(tables))], "version string, tables array<string>").coalesce(1).write.json(f"{root}/{version}/_pointer")
    before = _pointers(spark, root)
    number = max(time.time_ns(), int(before[-1]) + 1 if before else 0)
    fs.mkdirs(at(f"{root}/latest"))
    if not fs.rename(at(f"{root}/{version}/_pointer"), at(f"{root}/latest/{number:020d}")):
        fs.delete(at(f"{root}/{version}"), True)
        raise OSError(f"{root}: the new version couldn't be named")
    for old in before[:-1]:  # the last but one stays for readers that have just looked
        fs.delete(at(f"{root}/latest/{old}"), True)
    return version


def _files(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _pointers(spark: SparkSession, root: str) -> list[str]:
    fs, at = _files(spark, root)
    return sorted(s.getPath().getName() for s in fs.listStatus(at(f"{root}/latest"))) if fs.exists(at(f"{root}/latest")) else []


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = spark.read.json(f"{root}/latest/{_pointers(spark, root)[-1]}").first()["version"]
    return spark.read.parquet(f"{root}/{version}/{name}")


def write_json_array(df: DataFrame, path: str) -> None:
    """A JSON array with an object a line, U+2028 and U+2029 escaped, as files that in the order of their names are one array.

    Every task writes its own file; the brackets are two small files, of which one comes first and the other last.
    """
    spark = df.sparkSession
    body = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    body = F.replace(F.replace(body, F.lit("\u2028"), F.lit("\\u2028")), F.lit("\u2029"), F.lit("\\u2029"))
    fs, at = _files(spark, path)
    fs.delete(at(path), True)
    # written once with ids, as the last object, which has no comma, is known only then
    df.select(F.monotonically_increasing_id().alias("id"), body.alias("value")).write.parquet(f"{path}/_rows")
    rows = spark.read.schema("id long, value string").parquet(f"{path}/_rows")
    last = rows.agg(F.max("id")).first()[0]
    ended = F.when(F.col("id") == F.lit(last), F.col("value")).otherwise(F.concat("value", F.lit(",")))
    parts = max(1, rows.rdd.getNumPartitions())
    rows.repartitionByRange(parts, "id").sortWithinPartitions("id").select(ended).write.text(f"{path}/_body")
    for s in fs.listStatus(at(f"{path}/_body")):
        if s.getPath().getName().startswith("part-"):
            fs.rename(s.getPath(), at(f"{path}/{s.getPath().getName()}"))
    for done in ("_rows", "_body"):
        fs.delete(at(f"{path}/{done}"), True)
    for name, bracket in (("array-open.txt", "["), ("z-array-close.txt", "]")):
        out = fs.create(at(f"{path}/{name}"), True)
        out.write(bytearray(f"{bracket}\n", "utf-8"))
        out.close()
