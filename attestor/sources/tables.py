"""Scans and sinks.  A blank cell and NULL are the same thing: converted here, once on the way in and once out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestor.functions.canon import blank_to_null

#: The column that separates data from their metadata in a table file.
METADATA = "#"


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A table of texts with a header row; blank cells are NULL, and the separator column is left out."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.csv(path, header=True, schema=schema, multiLine=True, quote='"', escape='"', enforceSchema=False)
    return df.select(*[blank_to_null(F.col(f"`{c}`")).alias(c) for c in columns if c != METADATA])


def split_metadata(columns: Sequence[str], first: Sequence[str] = ()) -> list[str]:
    """Order of columns in a file: the given ones, other data sorted, the separator, confidences, bases."""
    meta = [c for c in columns if c.endswith(("_confidence", "_basis"))]
    data = [c for c in first if c in columns] + sorted(c for c in columns if c not in first and c not in meta)
    return data + ([METADATA] if meta else []) + sorted(c for c in meta if c.endswith("_confidence")) + sorted(c for c in meta if c.endswith("_basis"))


def write_csv(df: DataFrame, path: str, first: Sequence[str] = (), keys: Sequence[str] = ()) -> None:
    """Sorted by keys within range partitions, blanks for NULL, data before metadata."""
    order = split_metadata(df.columns, first)
    out = df.select(*[(F.lit("") if c == METADATA else F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))).alias(c) for c in order])
    if keys:
        out = out.orderBy(*keys)
    out.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")


def json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One document a file, with its file name."""
    return spark.read.schema(schema).json(path, multiLine=True).withColumn("_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def json_by_key(df: DataFrame, path: str, key: str) -> None:
    """One folder a key."""
    df.write.mode("overwrite").partitionBy(key).json(path)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, n, line) of text files, numbered from 1 within each."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return whole.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("_n", "line")).select("path", (F.col("_n") + 1).alias("n"), "line")


def decoded_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, n, line) of files in UTF-8, or else in GB18030 with replacement."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        for pdf in batches:
            rows = []
            for p, raw in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    text = bytes(raw).decode("utf-8")
                except UnicodeDecodeError:
                    text = bytes(raw).decode("gb18030", errors="replace")
                rows += [(p, n, line) for n, line in enumerate(text.splitlines(), 1)]
            yield type(pdf)(rows, columns=["path", "n", "line"])

    return files.mapInPandas(run, "path string, n int, line string")


def binary_prints(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, sha256, first_byte) of files."""
    df = spark.read.format("binaryFile").load(path)
    return df.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), F.conv(F.hex(F.substring("content", 1, 1)), 16, 10).cast("int").alias("first_byte"))


def zip_members(spark: SparkSession, path: str, marker: str) -> DataFrame:
    """(archive, member, size, content) of the members of zip files whose path has a marker."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        import io
        import zipfile

        for pdf in batches:
            rows = []
            for p, raw in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(bytes(raw))) as z:
                    rows += [(p, m.filename, m.file_size, z.read(m)) for m in z.infolist() if marker in m.filename and not m.is_dir()]
            yield type(pdf)(rows, columns=["archive", "member", "size", "content"])

    return files.mapInPandas(run, "archive string, member string, size long, content binary")


def key_values(lines: DataFrame, line: str = "line") -> DataFrame:
    """Key and value of lines such as 'k = v'; comments and other lines are left out."""
    pattern = r"^\s*([A-Za-z_][A-Za-z0-9_.-]*)\s*=\s*(.*?)\s*(?:#.*)?$"
    rows = lines.withColumn("key", F.regexp_extract(line, pattern, 1)).withColumn("value", F.regexp_extract(line, pattern, 2))
    return rows.where("key <> ''")


def or_empty(spark: SparkSession, read, schema: T.StructType) -> DataFrame:
    """What read() gives, or no rows if there is no such file."""
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def with_overrides(df: DataFrame, curated: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Verified values win over parsed ones."""
    own = curated.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in columns])
    out = df.join(own, list(keys), "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(f"_o_{c}", c)).drop(f"_o_{c}")
    return out


def pruned(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows of some partitions of a partitioned table: folders of the others are never listed or opened."""
    return df.where(F.col(column).isin(*values))


def required_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df, or an error if a column is missing: an answer of another shape is no empty table."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing; there are {df.columns}")
    return df


def register_views(spark: SparkSession, folder: str, names: Sequence[str]) -> None:
    """Tables of a folder as views by their names, for SQL over them."""
    for n in names:
        parquet(spark, folder, n).createOrReplaceTempView(n)
