"""File sources (§2.1): typed CSV scan, archive scan, file discovery.

The reference reads one file into memory; here a path (or folder, or glob)
is a distributed table: every matching file becomes part of it.
"""

from __future__ import annotations

import io
import os
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.clean import nan_to_null

EXTENSIONS = (".csv", ".xlsx", ".xls")


def read_csv(spark: SparkSession, path: str, schema: StructType | str, glob: str = "*.csv") -> DataFrame:
    """Headered CSV with an explicit schema (no inference pass); NaN -> NULL."""
    ext = os.path.splitext(path)[1].lower()
    if ext and ext not in (".csv", ""):
        raise ValueError(f"unsupported file extension {ext!r}")
    r = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    if not ext:
        r = r.option("pathGlobFilter", glob)
    return nan_to_null(r.csv(path))


def read_file(spark: SparkSession, path: str, schema) -> DataFrame:
    """Reader chosen by lower-cased extension; spreadsheets are not a distributed source."""
    ext = os.path.splitext(path)[1].lower()
    if ext == ".csv":
        return read_csv(spark, path, schema)
    if ext in (".xlsx", ".xls"):
        raise ValueError("spreadsheets are not supported: convert to CSV or Parquet upstream")
    raise ValueError(f"unsupported file extension {ext!r}")


def find_data_file(spark: SparkSession, directory: str) -> str | None:
    """First data file of a folder, CSV before XLSX before XLS (listing via Spark)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory) \
        .select("path").filter(F.lower("path").rlike(r"\.(csv|xlsx|xls)$"))
    ranked = files.withColumn("rk", F.when(F.lower("path").endswith(".csv"), 0)
                              .when(F.lower("path").endswith(".xlsx"), 1).otherwise(2)) \
        .orderBy("rk", "path").limit(1).collect()
    return ranked[0]["path"].replace("file:", "") if ranked else None


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def _unzip_lines(it, batch_lines: int = 100_000):
    """binaryFile rows -> (archive, member, line) for every data line of every
    .csv member, streamed in bounded batches."""
    cols = ["archive", "member", "line_no", "line"]
    for pdf in it:
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                zf = zipfile.ZipFile(io.BytesIO(content))
            except zipfile.BadZipFile as e:
                raise ValueError(f"not a zip archive: {path}") from e
            for name in zf.namelist():
                if not name.lower().endswith(".csv"):
                    continue
                out = []
                with zf.open(name) as fh:
                    for i, line in enumerate(io.TextIOWrapper(fh, encoding="utf-8")):
                        line = line.rstrip("\r\n")
                        if i == 0 or not line:  # header line / blank
                            continue
                        out.append((path, name, i, line))
                        if len(out) >= batch_lines:
                            yield pd.DataFrame(out, columns=cols)
                            out = []
                if out:
                    yield pd.DataFrame(out, columns=cols)


def read_zip_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV members of many zip archives as one table (one task per archive)."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    lines = raw.select("path", "content").mapInPandas(
        _unzip_lines, "archive string, member string, line_no int, line string")
    ddl = schema.simpleString()[len("struct<"):-1].replace(":", " ")
    parsed = lines.select(F.from_csv("line", ddl, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return nan_to_null(parsed)


def _filesystem(uri: str):
    """(pyarrow filesystem, path inside it) for a folder URI: ``file:``, ``hdfs:``,
    ``s3:`` ... or a plain path, so tasks write to the shared storage the
    session uses and not to a machine-local disk."""
    from pyarrow import fs as pafs
    if "://" not in uri:
        uri = "file://" + os.path.abspath(uri[len("file:"):] if uri.startswith("file:") else uri)
    return pafs.FileSystem.from_uri(uri)


def _zip_partition(folder, columns):
    def fn(it):
        fs = base = None
        zf = member = out = None
        final = tmp = None
        rows = 0
        for pdf in it:
            if pdf.empty:
                continue
            if zf is None:
                # deterministic name per partition + atomic rename: a retried task
                # overwrites its own archive instead of adding a second copy
                fs, base = _filesystem(folder)
                pid = int(pdf["__pid"].iloc[0])
                final = f"{base.rstrip('/')}/part-{pid:05d}.zip"
                tmp = f"{final}.{os.getpid()}.tmp"
                out = fs.open_output_stream(tmp)
                zf = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)  # streamed (no seek needed)
                member = zf.open("data.csv", "w", force_zip64=True)
                member.write(pdf[columns].head(0).to_csv(index=False).encode("utf-8"))
            member.write(pdf[columns].to_csv(index=False, header=False).encode("utf-8"))
            rows += len(pdf)
        if zf is not None:
            member.close()
            zf.close()
            out.close()
            fs.move(tmp, final)
            yield pd.DataFrame({"archive": [final], "rows": [rows]})
    return fn


#: Rows a file or archive holds where a writer chooses their number, which then follows the rows.
FILE_ROWS = 1_000_000


def file_count(df: DataFrame, least: int = 4) -> int:
    """Files that hold about FILE_ROWS rows each, ``least`` at least (one count)."""
    return max(least, -(-df.count() // FILE_ROWS))


def write_zip_csv(df: DataFrame, folder: str, partitions: int | None = None) -> DataFrame:
    """One zip archive (a CSV member) per partition, written by the tasks to the
    shared folder ``folder`` (any URI pyarrow's filesystems resolve); returns
    (archive, rows).  Rows are spread by a hash of all columns, so a retried
    task sees the same rows.  Without ``partitions`` their number follows the rows."""
    partitions = partitions or file_count(df)
    fs, base = _filesystem(folder)
    fs.create_dir(base, recursive=True)
    cols = df.columns
    parted = df.repartition(partitions, *[F.col(f"`{c}`") for c in cols]).withColumn("__pid", F.spark_partition_id())
    return parted.mapInPandas(_zip_partition(folder, cols), "archive string, rows long")
