"""Flow CSV ingest (S1-S9) and the capture-file provenance table.

Files are grouped by their header line (read by a Spark job with one short task
per file, or declared with ``header``), each group is read in ONE distributed
``spark.read.csv`` with an explicit all-string schema, and the groups are
combined with ``unionByName(allowMissingColumns=True)`` - so files whose
columns come in a different order cannot be misaligned.  Numbers are parsed
with ``try_cast`` (``Infinity``/``NaN`` parse, junk becomes NULL) and NaN
becomes NULL at ingest; +-Inf stays until cleaning (C1).
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.labels import normalise_label
from ..functions.missing import nan_to_null
from ..schema import CAPTURE_FILES, snake_name


def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(conf), p


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Glob on the cluster file system (metadata only)."""
    jvm, fs, p = _jvm_fs(spark, pattern)
    st = fs.globStatus(p)
    out = []
    for s in st or []:
        if s.isDirectory():
            for c in fs.listStatus(s.getPath()):
                n = c.getPath().getName()
                if c.isFile() and n.endswith(".csv"):
                    out.append(c.getPath().toString())
        elif s.getPath().getName().endswith(".csv"):
            out.append(s.getPath().toString())
    return sorted(out)


#: No file is larger; splits of this size hold a whole file.
_WHOLE_FILE = 1 << 60


def _first_lines(batches):
    """The first line of a file, from the batches of its one task; the rest is not read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def read_headers(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """Header line -> its files, by one Spark job.

    Every file is one split in a task of its own (settings of a separate SQL
    session, so the caller's are untouched) that stops after its first line:
    tasks read a buffer of text each, whatever the size of the files, and the
    driver opens none.  The driver gets a line per file, as it does from the
    listing.  Files without a line are left out."""
    s = spark.newSession()
    for name, value in (("spark.sql.files.maxPartitionBytes", _WHOLE_FILE), ("spark.sql.files.openCostInBytes", _WHOLE_FILE),
                        ("spark.sql.files.minPartitionNum", len(files)),
                        ("spark.sql.execution.arrow.maxRecordsPerBatch", 1)):
        s.conf.set(name, str(value))
    lines = s.read.text(files).select("value", F.col("_metadata.file_path").alias("file")) \
        .mapInArrow(_first_lines, "value string, file string")
    found = {_plain_path(r["file"]): r["value"] for r in lines.collect()}
    groups: dict[str, list[str]] = {}
    for f in files:
        line = found.get(re.sub("^file:/+", "/", f))
        if line is not None:
            groups.setdefault(line.removesuffix("\r"), []).append(f)
    return groups


def _plain_path(url: str) -> str:
    """A file's URL as the listing writes it (not encoded), without the scheme if it is a local file."""
    return re.sub("^file:/+", "/", unquote(url))


def dedupe_names(names: list[str]) -> list[str]:
    """Repeated header names become ``name.1``, ``name.2`` (pandas convention)."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n in seen:
            seen[n] += 1
            out.append(f"{n}.{seen[n]}")
        else:
            seen[n] = 0
            out.append(n)
    return out


def clean_names_snake(names) -> list[str]:
    """S3."""
    return [snake_name(n) for n in names]


def clean_names_strip(names) -> list[str]:
    """S4."""
    return [n.strip() for n in names]


def day_from_file(path_col: Column | None = None) -> Column:
    """Text before the first '-' of the file name, capitalised.  For
    Spark-written folders (``part-*`` files) the folder name is used."""
    p = path_col if path_col is not None else F.col("_metadata.file_path")
    name = F.regexp_extract(p, r"([^/]+)$", 1)
    parent = F.regexp_extract(p, r"([^/]+)/[^/]+$", 1)
    base = F.when(name.startswith("part-"), parent).otherwise(name)
    return F.initcap(F.split(base, "-").getItem(0))


def read_flows(spark: SparkSession, path: str, names: str = "strip", label: str = "Label",
               drop_columns=("fwd_header_length.1", "Fwd Header Length.1"), add_day: bool = True,
               fix_labels: bool = True, numeric: bool = True, header: str | None = None) -> DataFrame:
    """All flow CSVs under ``path`` (a folder or glob) as one DataFrame.

    ``header``: the header line that all files share, if known; no file is
    then opened before the job itself reads it."""
    pattern = path if any(ch in path for ch in "*?[") else path.rstrip("/") + "/*"
    files = list_files(spark, pattern)
    if not files:
        raise FileNotFoundError(f"{path} holds no flow files (*.csv)")
    groups = {header: files} if header is not None else read_headers(spark, files)
    if not groups:
        raise ValueError(f"the flow files of {path} are all empty")
    clean = clean_names_snake if names == "snake" else clean_names_strip
    label_name = clean([label])[0]
    parts = []
    for line, paths in groups.items():
        raw = line.split(",")
        cols = dedupe_names(clean(raw))
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
        d = (spark.read.schema(schema).option("header", True).option("ignoreLeadingWhiteSpace", True)
             .option("ignoreTrailingWhiteSpace", True).option("enforceSchema", True).csv(paths))
        if add_day:
            d = d.withColumn("Day" if names == "strip" else "day", day_from_file())
        parts.append(d)
    df = parts[0]
    for d in parts[1:]:
        df = df.unionByName(d, allowMissingColumns=True)
    df = df.drop(*[c for c in drop_columns if c in df.columns])
    keep_str = {label_name, "Day", "day"}
    if numeric:
        df = df.withColumns({c: nan_to_null(F.expr(f"try_cast(`{c}` AS DOUBLE)"))
                             for c in df.columns if c not in keep_str})
    if fix_labels and label_name in df.columns:
        df = df.withColumn(label_name, normalise_label(label_name))
    return df


def content_ids(df: DataFrame, out: str = "row_id") -> DataFrame:
    """Adds an id that depends on the rows' contents alone: the hash of the row
    and of its number among equal rows.  Equal rows are counted and multiplied
    again, so a row repeated very often costs one group, and neither file
    splits nor core counts change an id."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))) \
        .withColumn(out, F.xxhash64(*cols, "_copy")).drop("_copies", "_copy")


def capture_files(spark: SparkSession) -> DataFrame:
    """File -> day and attack content."""
    return spark.createDataFrame(CAPTURE_FILES, "file string, day string, content string")
