"""Readers. Schemas are given, never inferred; bad rows are kept aside."""
import csv
import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

BAD_ROW = "_bad_row"
LINE_BITS = 16  # a block of lines has at most two to the power of it

# Text form of times in exchanged files; keeps microseconds.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _schema(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def jdbc_table(spark: SparkSession, url: str, name: str, key: str, low: int, high: int, partitions: int,
               **options) -> DataFrame:
    """One partitioned scan by id range; takes the place of offset paging."""
    return spark.read.options(**options).jdbc(url, name, column=key, lowerBound=low, upperBound=high,
                                              numPartitions=partitions)


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Names, sizes and days of the files below a folder; no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(F.col("path").alias("file_name"), F.col("length").alias("n_bytes"), "modificationTime",
                                    file_day(F.col("path")).alias("file_date"))


def csv_files(spark: SparkSession, path: str | list, schema, pattern: str | None = None, encoding: str = "UTF-8",
              header: bool = True, sep: str = ",") -> DataFrame:
    """All matching files as one frame, with the file each row came from.

    Rows that do not fit the schema come back with their text in ``_bad_row``.
    """
    fields = _schema(schema)
    reader = spark.read.schema(T.StructType(fields.fields + [T.StructField(BAD_ROW, T.StringType())])).options(
        header=header, sep=sep, encoding=encoding, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_ROW, **TIME_FORMATS)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return reader.csv(path).withColumn("file_name", F.col("_metadata.file_path"))


def text_csv(spark: SparkSession, path: str, columns: list, **options) -> DataFrame:
    """Every column as text, for dumps whose types cannot be trusted."""
    return csv_files(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in columns]), **options)


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``, ``file_name`` and the line's exact number in its file, ``line`` (from 0) of ``n_lines``.

    A file is scanned in blocks, each by one task. The lines of a block are
    numbered in the scan, and 65,536 of them close it; what the blocks
    before hold is a prefix sum over the blocks of the file, so nothing is
    sorted and a file may have any size.
    """
    at = F.monotonically_increasing_id()
    scanned = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file_name"), F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.shiftright(at, LINE_BITS).alias("piece")).alias("_block"), at.alias("_at"))
    blocks = scanned.groupBy("_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before, whole = Window.partitionBy("_block.file").orderBy("_block.start", "_block.piece").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_block.file")
    blocks = blocks.select("_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("n_lines"))
    return scanned.join(blocks, "_block").select("value", "file_name", (F.col("_at") - F.col("_first") + F.col("_before")).alias("line"), "n_lines", "_block")


def csv_records(lines: DataFrame, quote: str = '"') -> DataFrame:
    """``file_name, value``: the lines of ``file_lines`` with those of a quoted line break put together again.

    A record ends where the quotes of its file so far are even in number. A
    block counts quotes and, for an even and an odd start, the records that end
    in it; prefix sums over the blocks of a file tell which of the two holds and
    how many records ended before. Only records with a break in them are
    gathered. A quote that is never closed takes the rest of its file.
    """
    inside = Window.partitionBy("_block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    counted = lines.withColumn("_quotes", quotes).withColumn("_in", F.sum("_quotes").over(inside)).withColumn("_even", F.col("_in") % 2 == 0)
    counted = counted.withColumns({"_n_even": F.count_if("_even").over(inside), "_n_odd": F.count_if(~F.col("_even")).over(inside)})
    blocks = counted.groupBy("_block").agg(F.max("_in").alias("_q"), F.max("_n_even").alias("_e"), F.max("_n_odd").alias("_o"))
    before = Window.partitionBy("_block.file").orderBy("_block.start", "_block.piece").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_odd", F.coalesce(F.sum("_q").over(before), F.lit(0)) % 2 == 1)
    ended = F.sum(F.when(F.col("_odd"), F.col("_o")).otherwise(F.col("_e"))).over(before)
    rows = counted.join(blocks.select("_block", "_odd", F.coalesce(ended, F.lit(0)).alias("_ended")), "_block")
    ends = F.col("_even") != F.col("_odd")
    number = F.col("_ended") + F.when(F.col("_odd"), F.col("_n_odd")).otherwise(F.col("_n_even")) - F.when(ends, 1).otherwise(0)
    begins = ends == (F.col("_quotes") % 2 == 0)
    rows = rows.select("file_name", "value", "line", number.alias("_record"), (begins & ends).alias("_whole"))
    broken = rows.filter("not _whole").groupBy("file_name", "_record").agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("_lines"))
    return rows.filter("_whole").select("file_name", "value").unionByName(
        broken.select("file_name", F.array_join(F.col("_lines.value"), "\n").alias("value")))


def csv_after_preamble(spark: SparkSession, path: str, schema, skip: int, drop_last: int = 0) -> DataFrame:
    """CSV whose files open with ``skip`` lines that are no data (the header line counts as one; columns go by position) and may
    close with ``drop_last`` footer lines. Values may hold line breaks in quotes; a doubled quote stands for one."""
    fields = _schema(schema)
    body = file_lines(spark, path).filter((F.col("line") >= skip) & (F.col("line") < F.col("n_lines") - drop_last))
    row = F.from_csv(F.col("value"), fields.simpleString()[len("struct<"):-1].replace(":", " "), {"escape": '"', "multiLine": "true"})
    return csv_records(body).select(row.alias("_row"), "file_name").select(
        *[F.col(f"_row.{f.name}").alias(f.name) for f in fields.fields], "file_name")


def file_day(c: Column, pattern: str = r"(\d{4}-\d{2}-\d{2})") -> Column:
    """Date written in a file name or folder name; null if there is none."""
    return F.regexp_extract(c, pattern, 1).try_cast("date")


def latest_files(df: DataFrame, day: Column | None = None) -> DataFrame:
    """Rows of the newest file day."""
    return as_of_latest(df.withColumn("file_date", day if day is not None else file_day(F.col("file_name"))), "file_date")


def newer_files(df: DataFrame, loaded_until: dt.date, day: Column | None = None) -> DataFrame:
    """Rows of files newer than the newest loaded one."""
    return df.withColumn("file_date", day if day is not None else file_day(F.col("file_name"))).filter(
        F.col("file_date") > F.lit(loaded_until))


def newest_files(spark: SparkSession, path: str, schema, pattern: str | None = None, loaded_until: dt.date | None = None, **options) -> DataFrame | None:
    """Rows of the newest file day, found in the listing: older files are not opened.

    With ``loaded_until`` the rows replace what is loaded only if they are newer; otherwise there is nothing to load, None.
    """
    files = list_files(spark, path, pattern)
    newest = files.agg(F.max("file_date")).first()[0]
    if newest is None or (loaded_until is not None and newest <= loaded_until):
        return None
    folders = files.filter(F.col("file_date") == F.lit(newest)).select(F.regexp_extract("file_name", "^(.*)/[^/]*$", 1).alias("folder"), "file_name")
    # A day has a folder of its own, or its name stands in its files' names.
    names = [r[0] for r in folders.filter(file_day(F.col("folder")) == F.lit(newest)).select("folder").distinct().collect()]
    if names:
        return csv_files(spark, names, schema, pattern, **options).withColumn("file_date", F.lit(newest))
    return csv_files(spark, [r[0] for r in folders.select("folder").distinct().collect()], schema, f"*{newest}*", **options).withColumn("file_date", F.lit(newest))


def load_audit(df: DataFrame, files: DataFrame, source: str, expected_days: DataFrame) -> DataFrame:
    """Per expected file day: how many files (from the listing) and rows (from the scan) arrived, and a verdict."""
    rows = df.groupBy(file_day(F.col("file_name")).alias("file_date")).agg(F.count(F.lit(1)).alias("n_rows"))
    listed = files.groupBy("file_date").agg(F.count(F.lit(1)).alias("n_files"))
    out = expected_days.join(listed, "file_date", "left").join(rows, "file_date", "left").na.fill(0, ["n_files", "n_rows"])
    status = F.when(F.col("n_files") == 0, "missing").when(F.col("n_rows") == 0, "empty").otherwise("loaded")
    return out.select(F.lit(source).alias("source"), "file_date", "n_files", "n_rows", status.alias("status"))


def json_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(_schema(schema)).json(path)


def lookup(spark: SparkSession, path: str, renames: dict) -> DataFrame:
    """Reference list: named columns of a CSV under their warehouse names."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select([F.trim(F.col(f"`{src}`")).alias(dst) for src, dst in renames.items()])


def sheet(spark: SparkSession, path: str, renames: dict, header_line: int) -> DataFrame:
    """A sheet saved as CSV whose header stands at a line of its own below titles: named columns under their warehouse names, as text.

    The driver reads the one header line; blanks around names and values go, rows without any of the columns are left out.
    """
    lines = file_lines(spark, path)
    head = lines.filter(F.col("line") == header_line).select("value").first()
    names = [] if head is None else [(n or "").strip() for n in next(csv.reader([head[0]]))]
    missing = [c for c in renames if c not in names]
    if missing:
        raise ValueError(f"no column {missing} in line {header_line}: {names}")
    raw = csv_after_preamble(spark, path, ", ".join(f"c{i} string" for i in range(len(names))), header_line + 1)
    return raw.select([F.nullif(F.trim(F.col(f"c{names.index(src)}")), F.lit("")).alias(dst) for src, dst in renames.items()]).dropna("all")


def as_of_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows that carry the largest value of a column (newest model version). The
    largest value is a scalar subquery, so the filter stays in the scan."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())
