"""Files as DataFrames: recursive scans, text, CSV and HTML to Markdown, JSON lines with tolerance for bad ones."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillstone.session import ship
from quillstone.sources.markdown import to_markdown

#: Extensions that are taken.
EXTENSIONS = ["pdf", "docx", "pptx", "xlsx", "html", "csv", "txt"]


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """All files below folder with a known extension: source_path, extension, size_bytes, mtime, file_hash, content. Spark's own reader lists them, so any store does."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return raw.select(F.col("path").alias("source_path"), ext.alias("extension"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("mtime"), F.sha2("content", 256).alias("file_hash"), "content").filter(F.col("extension").isin(EXTENSIONS))


def stem(path):
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def suffix(path):
    """The extension in lower case, with its point."""
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))


def text_documents(files: DataFrame) -> DataFrame:
    """Text files as Markdown: the whole text, titled by the file's stem."""
    return files.filter("extension = 'txt'").select("source_path", "file_hash", stem(F.col("source_path")).alias("title"), F.decode("content", "UTF-8").alias("markdown"))


def csv_table(rows: DataFrame) -> DataFrame:
    """rows with `line`: the row as a Markdown table line, and header lines as a second column of constants."""
    cell = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in rows.columns]), F.lit(" |"))
    head = "| " + " | ".join(rows.columns) + " |\n|" + "---|" * len(rows.columns)
    return rows.select("*", line.alias("line"), F.lit(head).alias("header"))


def read_csv(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """CSV files with a header as a Markdown table (a row a line, see csv_table), and their metadata: rows and columns."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return csv_table(rows), {"rows": rows.count(), "columns": rows.columns}


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = [to_markdown(h.as_py() or "") for h in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([t for t, _ in done], pa.string()), pa.array([m for _, m in done], pa.string())], names=["page_id", "url", "title", "markdown"])


def html_markdown(pages: DataFrame) -> DataFrame:
    """page_id, url, title, markdown of HTML pages (page_id, url, html). A page without title is titled by its address's stem."""
    ship(pages.sparkSession)
    out = pages.select("page_id", "url", "html").mapInArrow(_pages, "page_id long, url string, title string, markdown string")
    return out.withColumn("title", F.coalesce(F.nullif(F.trim("title"), F.lit("")), stem(F.col("url"))))


def json_lines(spark: SparkSession, path: str, schema: str, required: str | None = None) -> DataFrame:
    """JSON lines; malformed ones, blank ones and ones without the required field are left out."""
    rows = spark.read.schema(f"{schema}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    good = rows.filter(F.col("_bad").isNull()).drop("_bad")
    return good.filter(F.col(required).isNotNull()) if required else good


def json_documents(rows: DataFrame, schema: str, required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The JSON documents of rows (file, body) as file and the columns of schema, and the quarantine (file, reason) of those that can't be read. Each row is in exactly one of them.

    Documents may have more fields, and lack any but the required ones. Reasons: empty, malformed (not JSON, or cut short), not an object, missing: a required field that is absent or null, wrong type: a field that can't be cast. The first that holds is told. One pass, without schema inference.
    """
    fields = StructType.fromDDL(schema)
    # as the one element of an array, since the parser lets anything follow a whole document
    array = F.try_parse_json(F.concat(F.lit("["), "body", F.lit("]")))
    told = rows.select("file", "body", array.alias("_a")).select("file", "body", F.when(F.try_variant_get("_a", "$[1]", "variant").isNull(), F.try_variant_get("_a", "$[0]", "variant")).alias("v"))
    value = lambda f, kind: F.try_variant_get("v", f"$['{f}']", kind)
    lacking = lambda f: value(f, "variant").isNull() | F.is_variant_null(value(f, "variant"))
    reason = F.when(F.coalesce(F.trim(F.translate("body", "\n\r\t", "   ")), F.lit("")) == "", "empty").when(F.col("v").isNull(), "malformed").when(~F.schema_of_variant("v").startswith("OBJECT"), "not an object")
    for f in required or []:
        reason = reason.when(lacking(f), f"missing: {f}")
    for f in fields:
        reason = reason.when(~lacking(f.name) & value(f.name, f.dataType.simpleString()).isNull(), f"wrong type: {f.name}")
    judged = told.withColumn("reason", reason)
    good = judged.filter("reason is null").select("file", *[value(f.name, f.dataType.simpleString()).alias(f.name) for f in fields])
    return good, judged.filter("reason is not null").select("file", "reason")


def read_json_folder(spark: SparkSession, folder: str, schema: str, required: list[str] | None = None, pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """json_documents() of all files below folder whose names fit the pattern, one document a file; bytes that are no UTF-8 are malformed. Files are read whole by Spark, so a folder of any number of them is."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    body = F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.lit("?"))
    # Spark's scans pass over files without a byte; its list of files, which the driver holds anyway, has them
    listed = spark.createDataFrame([(re.sub("^file:/+", "file:/", unquote(f)),) for f in raw.inputFiles()], "path string")
    hollow = listed.join(raw.select("path"), "path", "left_anti").select("path", F.lit("").alias("body"))
    every = raw.select("path", body.alias("body")).unionByName(hollow)
    return json_documents(every.select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "body"), schema, required)


def read_classified(spark: SparkSession, pattern: str, schema: str | None = None) -> DataFrame:
    """Classified files, a JSON document each, with their file name; files that are no JSON are left out."""
    reader = spark.read.schema(f"{schema}, _bad string") if schema else spark.read
    rows = reader.option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(pattern).withColumn("file_name", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))
    return rows.filter(F.col("_bad").isNull()).drop("_bad") if "_bad" in rows.columns else rows


MANIFEST = "source_path string, file_hash string, mtime double, size_bytes long, status string, output_path string, error string, processed_at string"


def _versions(spark: SparkSession, path: str):
    """The file system and the manifest's versions that were written to the end, oldest first."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(at)] if fs.exists(at) else []
    done = [p for p in found if p.getName().startswith("v") and p.getName()[1:].isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return fs, sorted(done, key=lambda p: int(p.getName()[1:]))


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest's last whole version; empty without one. One that can't be read is set aside as <version>.corrupt with a warning, and the one before it counts."""
    fs, versions = _versions(spark, path)
    for p in reversed(versions):
        try:
            rows = spark.read.schema(MANIFEST).parquet(p.toString())
            rows.count()
            return rows
        except Exception as e:
            warnings.warn(f"manifest {p} can't be read and is set aside: {e}", stacklevel=2)
            fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(f"{p.toString()}.corrupt"))
    return spark.createDataFrame([], MANIFEST)


def save_manifest(rows: DataFrame, path: str) -> None:
    """Write rows as the manifest's next version. It counts once it is whole, so a run that breaks off leaves the version before."""
    spark = rows.sparkSession
    _, versions = _versions(spark, path)
    number = int(versions[-1].getName()[1:]) + 1 if versions else 1
    names = [f.split()[0] for f in MANIFEST.split(", ")]
    rows.select(*names).write.mode("overwrite").parquet(f"{path}/v{number}")


def write_index(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
