"""Object-store file sources: CSV, JSON (array / object / JSON lines), text.

Every reader returns rows plus ``source_file`` (the object name relative to the scanned folder).
A folder is listed and read by Spark's readers only: no path ever goes through the driver, and no
file is opened again by a name taken from the data, so blanks, brackets and percent signs in names are safe.

What belongs to a file as a whole (a CSV header, the kind of a JSON file) is a table with one row per file.
It always stands on the right of a left, semi or anti join, so the rows of the files are never the broadcast side; whether
it is broadcast is left to its measured size.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from heliolake.functions.text import strip
from heliolake.sources.cutting import LONGEST, cut

SOURCE_FILE = "source_file"


class MissingSource(FileNotFoundError):
    """The bucket/root folder itself does not exist (an error, unlike an empty folder)."""


def _qualified(spark: SparkSession, root: str):
    """The root as the file system names it, and whether it exists."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toUri().getPath().rstrip("/"), bool(fs.exists(p))


def _extension_glob(extension: str | None) -> str | None:
    """File names by extension, in either case; ``none`` (or nothing) takes every file."""
    if not extension or extension.lower() == "none":
        return None
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension.lstrip("."))


def _reader(reader, extension: str | None):
    reader = reader.option("recursiveFileLookup", "true")
    glob = _extension_glob(extension)
    return reader.option("pathGlobFilter", glob) if glob else reader


def _escaped(root: str) -> str:
    """The folder's own name taken literally (Spark reads paths as globs)."""
    return "".join("\\" + c if c in "[]{}*?\\" else c for c in root.rstrip("/"))


def source_name(root_path: str, file_path: Column) -> Column:
    """Object name relative to the scanned root (keeps sub-folders), percent signs decoded.

    ``root_path`` is the path of the qualified root; it is stripped by its length, wherever its name occurs again.
    """
    path = F.regexp_replace(file_path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.substring(decoded, F.lit(len(root_path) + 2), F.length(decoded))


def _load(reader, root: str, files: Sequence[str] | None = None) -> DataFrame | None:
    if files is not None and not files:
        return None
    try:
        return reader.load(_escaped(root) if files is None else [_escaped(f) for f in files])
    except Exception as e:  # noqa: BLE001 - an empty folder has no files to infer from
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER" in str(e) or "Unable to infer" in str(e):
            return None
        raise


def read_lines(spark: SparkSession, root: str, extension: str | None = None, *, stream: bool = False, files: Sequence[str] | None = None) -> DataFrame | None:
    """Raw lines ``(value, source_file, _block, _path)`` split on ``\\n`` only (so a trailing
    ``\\r`` stays in the line and is stripped later, like Python's ``split('\\n')``).

    Returns None for an empty folder / no matching file (S14); raises MissingSource when the
    root itself is missing. ``files`` names files of the folder to read instead of all.
    """
    root_path, there = _qualified(spark, root)
    if not there:
        raise MissingSource(root)
    reader = (spark.readStream if stream else spark.read).format("text").option("lineSep", "\n")
    df = _load(_reader(reader, extension), root, files)
    if df is None:
        return None
    return df.select("value", source_name(root_path, F.col("_metadata.file_path")).alias(SOURCE_FILE),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.col("_metadata.file_path").alias("_path"))


def read_records(spark: SparkSession, root: str, extension: str | None, kind: str, files: Sequence[str] | None = None) -> DataFrame | None:
    """Records of JSON or CSV files of any size, cut by many tasks (:func:`heliolake.sources.cutting.cut`); None and
    MissingSource as :func:`read_lines`."""
    root_path, there = _qualified(spark, root)
    if not there:
        raise MissingSource(root)
    def scan(separator: str, longest: int | None, paths: Sequence[str] | None) -> DataFrame | None:
        reader = _reader(spark.read.format("text").option("lineSep", separator), extension)
        if longest is not None:
            reader = reader.option("mapreduce.input.linerecordreader.line.maxlength", longest)
        df = _load(reader, root, files if paths is None else [_plain(spark, p) for p in paths])
        if df is None:
            return None
        m = F.col("_metadata")
        return df.select(F.col("value").cast("binary").alias("value"), m["file_path"].alias("path"), m["file_block_start"].alias("block"),
                         (m["file_block_start"] + m["file_block_length"] >= m["file_size"]).alias("last"), m["file_size"].alias("size"))
    if scan("\n", None, None) is None:
        return None
    return cut(spark, scan, kind).withColumn(SOURCE_FILE, source_name(root_path, F.col("path")))


def _plain(spark: SparkSession, file_path: str) -> str:
    """The name of a file that ``_metadata.file_path`` gives (with percent signs), as a reader takes it."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file_path)).toString()


def text_lines(df: DataFrame, text_col: str = "content", source_col: str = SOURCE_FILE,
               line_col: str | None = "line_no") -> DataFrame:
    """S9/F28 on a table of whole texts: split on ``\\n``, strip, drop blank lines."""
    exploded = df.select(F.col(source_col), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("_pos", "_line"))
    out = exploded.select(F.col(source_col), (F.col("_pos") + 1).alias(line_col or "_pos"),
                          strip(F.col("_line")).alias("content")).filter(F.col("content") != "")
    return out.select(source_col, *( [line_col] if line_col else []), "content")


def read_text(spark: SparkSession, root: str, extension: str | None = None, *,
              skip_binary: bool = True, files: Sequence[str] | None = None) -> DataFrame:
    """Text files -> ``(content, source_file)``; blank lines dropped; files that are
    not valid UTF-8 are skipped whole."""
    lines = read_lines(spark, root, extension, files=files)
    if lines is None:
        return spark.createDataFrame([], "content string, source_file string")
    out = lines.select(strip(F.col("value")).alias("content"), SOURCE_FILE, "_path")
    if skip_binary:
        bad = (lines.groupBy("_path").agg(F.bool_and(F.is_valid_utf8("value")).alias("_ok"))
               .filter(~F.col("_ok")).select("_path"))
        out = out.join(bad, "_path", "left_anti")
    return out.filter(F.col("content") != "").select("content", SOURCE_FILE)


def _first_lines(lines: DataFrame, nonblank: bool = False) -> DataFrame:
    """Per file: its first (optionally first non-blank) line, by read order in split 0."""
    src = lines.filter(F.col("_block") == 0)
    if nonblank:
        src = src.filter(strip(F.col("value")) != "")
    src = src.withColumn("_id", F.monotonically_increasing_id())
    return src.groupBy("_path").agg(F.min_by("value", "_id").alias("_first"), F.min("_id").alias("_first_id"))


_CSV = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "nullValue": "\u0000", "emptyValue": "", "multiLine": "true"}


_END = "\u0001end\u0001"


def _cells(record: Column, width: int) -> Column:
    """The fields of one CSV record, at most ``width``: an empty one is ``''``, and one beyond the record's end is missing.

    A mark behind the record's last field tells an empty field from one that is not there, which the parser both gives as NULL.
    """
    row = F.from_csv(F.concat(record, F.lit(f",{_END}")), F.lit(", ".join(f"c{i} string" for i in range(width + 1))), _CSV)
    fields = F.array(*[row[f"c{i}"] for i in range(width + 1)])
    there = F.coalesce(F.nullif(F.array_position(fields, _END), F.lit(0)) - 1, F.lit(width)).cast("int")
    return F.transform(F.slice(fields, F.lit(1), there), lambda c: F.coalesce(c, F.lit("")))


def _commas(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))


def read_csv(spark: SparkSession, root: str, columns: Mapping[str, tuple[str, object]], *,
             extension: str | None = "csv", multiline: bool = True, files: Sequence[str] | None = None) -> DataFrame:
    """CSV files with a header. ``columns`` maps name -> (dtype, default-when-column-absent).

    Columns are matched by *header name per file* (files may differ); an absent column gives
    its default, extra columns are ignored. An empty or non-numeric value in a typed column,
    or a short row, rejects that row only (``_reject`` holds the reason).

    Quotes are a CSV reader's quotes: commas, doubled quotes and line breaks inside them belong to the field, in header and
    body. A large file is cut into records by many tasks, each of which knows whether its block begins inside quotes.
    ``multiline=False`` takes every line for a record and saves that; it is for folders whose fields are known to
    hold no line breaks. Only the widest header's size reaches the driver.
    """
    names = list(columns)
    if multiline:
        records = read_records(spark, root, extension, "csv", files)
    else:
        records = read_lines(spark, root, extension, files=files)
    if records is None:
        schema = ", ".join(f"{n} {columns[n][0]}" for n in names)
        return spark.createDataFrame([], f"{schema}, {SOURCE_FILE} string, _reject string")
    if multiline:
        records = records.withColumnsRenamed({"path": "_path", "text": "_record"})
        heads = records.filter("first").select("_path", F.rtrim("_record", F.lit("\r")).alias("_record"))
        body = records.filter("NOT first")
    else:
        heads = _first_lines(records).select("_path", F.rtrim("_first", F.lit("\r")).alias("_record"))
        body = records.withColumn("_id", F.monotonically_increasing_id()).withColumnRenamed("value", "_record")
        body = body.join(_first_lines(records).select("_path", "_first_id"), "_path", "left").filter("NOT (_block = 0 AND _id = _first_id)")
    most = (heads.agg(F.max(_commas(F.col("_record")))).first()[0] or 0) + 1
    heads = heads.select("_path", F.transform(_cells(F.col("_record"), most), strip).alias("_hdr"))
    heads = heads.select("_path", *[F.array_position("_hdr", F.lit(n)).cast("int").alias(f"_pos{i}")
                                   for i, n in enumerate(names)], F.size("_hdr").alias("_width"))
    width = (heads.agg(F.max("_width")).first()[0] or 0) + 1
    record = F.rtrim("_record", F.lit("\r"))
    rows = body.filter(record != "").select(_cells(record, width).alias("_fa"), SOURCE_FILE, "_path",
                                            F.spark_partition_id().alias("_parse_task"))          # keeps the parse below later filters
    rows = rows.join(heads, "_path", "left")
    out_cols, problems = [], []
    for i, name in enumerate(names):
        dtype, default = columns[name]
        pos = F.col(f"_pos{i}")
        raw = F.when(pos > 0, F.get(F.col("_fa"), pos - 1))
        if dtype == "string":
            val = F.when(pos > 0, raw).otherwise(F.lit(default))
            problems.append(F.when((pos > 0) & raw.isNull(), F.lit(f"short_row_{name}")))
        else:
            typed = raw.try_cast(dtype)
            val = F.when(pos > 0, typed).otherwise(F.lit(default).cast(dtype))
            problems.append(F.when((pos > 0) & typed.isNull(), F.lit(f"bad_{name}")))
        out_cols.append(val.cast(dtype).alias(name))
    problems.append(F.when(F.col("_parse_task") < 0, F.lit("unreachable")))
    return rows.select(*out_cols, F.col(SOURCE_FILE), F.coalesce(*problems).alias("_reject"))


def read_json(spark: SparkSession, root: str, *, extension: str | None = "json", schema=None, files: Sequence[str] | None = None) -> DataFrame:
    """JSON files holding an array, one object, or JSON lines, of any size.

    Output ``(value string-JSON-object, source_file, _reject)``: one row per object. The first character that is not blank
    tells a file's kind: ``[`` begins an array, ``{`` an object (JSON lines, if it closes on its line), anything else JSON
    lines. Elements of an array are cut and parsed by many tasks, and each is judged by itself: a bad one rejects itself only. What
    follows the array's or object's end is read as JSON lines, and so is an element or object that never ends. Blank elements and
    lines are dropped. One record may have 128 MiB, what a variant holds (``beyond_variant_limit``).

    ``schema`` (a StructType or a DDL text) names the fields to keep, each with its own JSON type; all by default.
    """
    records = read_records(spark, root, extension, "json", files)
    if records is None:
        return spark.createDataFrame([], f"value string, {SOURCE_FILE} string, _reject string")
    text = strip(F.col("text"))
    # Spark's parser stops after the first value: a record must end as it begins, and hold one value
    braces = text.startswith("{") & text.endswith("}")
    whole = F.col("line") & text.endswith("}") | ~F.col("line") & (F.col("opens") <= 1) & (braces | ~text.startswith("{"))
    parsed = (records.filter(F.col("text").isNull() | (text != ""))
              .withColumn("_v", F.when(whole, F.try_parse_json(text)))
              .withColumn("_parse_task", F.spark_partition_id()))      # parse once, below later filters
    if schema is not None:
        names = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
        quoted = [n.replace("\\", "\\\\").replace("'", "\\'") for n in names]
        kept = F.to_json(F.struct(*[F.try_variant_get("_v", f"$['{q}']", "variant").alias(n) for q, n in zip(quoted, names)]))
    else:
        kept = F.to_json("_v")
    is_object = F.schema_of_variant("_v").startswith("OBJECT")
    bad = F.when(F.col("line"), F.lit("invalid_json_line")).otherwise(F.lit("invalid_json_element"))
    return parsed.select(
        F.when(is_object, kept).when(F.col("_v").isNotNull(), F.to_json("_v")).alias("value"), SOURCE_FILE,
        F.when(F.coalesce(F.octet_length("text") > LONGEST, F.lit(True)), F.lit("beyond_variant_limit")).when(F.col("_v").isNull(), bad)
        .when(~is_object, F.lit("not_an_object"))
        .when(F.col("_parse_task") < 0, F.lit("unreachable")).alias("_reject"))


def with_source(df: DataFrame, value_col: str = "value") -> Column:
    """the record JSON with ``source_file`` merged in (the file name wins)."""
    from heliolake.operators.codec import merge_field
    return merge_field(value_col, SOURCE_FILE, F.col(SOURCE_FILE))


def preview(df: DataFrame, n: int = 100, order_by=None) -> DataFrame:
    """The first ``n`` rows (by ``order_by`` when given — a top-k, not a sort)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def folder_stats(spark: SparkSession, root: str, extension: str | None = None) -> DataFrame:
    """Number of matching files and their total size (from file metadata only)."""
    df = _load(_reader(spark.read.format("binaryFile"), extension), root)
    sizes = df.select("length") if df is not None else spark.createDataFrame([], "length long")
    return sizes.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def csv_preview(spark: SparkSession, root: str, n: int = 100, extension: str = "csv") -> tuple[list[str], DataFrame, DataFrame]:
    """``(header, first n rows of the first CSV file by name, folder stats)``.

    The first file is picked from file metadata; a filter on it prunes the others, so only that file is read for
    rows. The limit is the feature (a preview).
    """
    stats = folder_stats(spark, root, extension)
    listed = _load(_reader(spark.read.format("binaryFile"), extension), root)
    first = listed.agg(F.min("_metadata.file_path")).first()[0] if listed is not None else None
    if first is None:
        return [], spark.createDataFrame([], "value string"), stats
    plain = _reader(spark.read.format("text"), extension).load(_escaped(root))
    widest = plain.filter(F.col("_metadata.file_path") == first).agg(
        F.max(F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))))
    width = (widest.first()[0] or 0) + 1
    reader = _reader(spark.read.format("csv").schema(", ".join(f"c{i} string" for i in range(width))).options(**_CSV).option("multiLine", "true"), extension)
    rows = reader.load(_escaped(root)).filter(F.col("_metadata.file_path") == first)
    numbered = rows.withColumn("_id", F.monotonically_increasing_id()).orderBy("_id").limit(n + 1)
    head = numbered.first()
    header = [c.strip() for c in head[:width] if c is not None] if head else []
    body = numbered.filter(F.col("_id") > (head["_id"] if head else -1)).orderBy("_id").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(header)])
    return header, body, stats


def folder_topic(spark: SparkSession, root: str, topic: str, file_format: str = "json", *, columns: Mapping[str, tuple[str, object]] | None = None,
                 schema=None, timestamp: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """S5-S11 + F29 + K1: every record of a folder as a message: ``(messages, rejected rows)``.

    The key is the file's name, and the value is the record with ``source_file`` merged in (the file's name wins).
    """
    from heliolake.sources.topic import as_topic
    df = read_folder(spark, root, file_format, columns=columns, schema=schema)
    if "_reject" not in df.columns:
        df = df.withColumn("_reject", F.lit(None).cast("string"))
    good = df.filter(F.col("_reject").isNull()).drop("_reject")
    value = with_source(good) if (file_format or "").lower().lstrip(".") == "json" else F.to_json(F.struct(*good.columns))
    return (as_topic(good, key=F.col(SOURCE_FILE), value=value, topic=topic, timestamp=timestamp), df.filter(F.col("_reject").isNotNull()))


# ---- fixed values: the printer-temperature CSV layout and its defaults for absent columns ----
PRINTER_COLUMNS = {
    "timestamp": ("string", ""),
    "hotend_temperature": ("double", 0.0),
    "bed_temperature": ("double", 0.0),
    "ambient_temperature": ("double", 0.0),
    "fluctuated_ambient_temperature": ("double", 0.0),
}
# ---------------------------------------------------------------------------------------------


def read_folder(spark: SparkSession, root: str, file_format: str = "none", *,
                columns: Mapping[str, tuple[str, object]] | None = None, schema=None,
                max_rows: int | None = None) -> DataFrame:
    """S5–S14 as one source: dispatch on the configured format like the bucket source does.

    ``csv`` -> :func:`read_csv` (``columns``, default the printer layout); ``json`` ->
    :func:`read_json`; any other extension -> :func:`read_text` on files with that extension;
    ``none`` -> every file read as text. Rows carry ``source_file``; rejected rows keep their
    reason. ``max_rows`` (S12) caps the rows returned — no cap by default.
    """
    fmt = (file_format or "none").lower().lstrip(".")
    if fmt == "csv":
        df = read_csv(spark, root, columns or PRINTER_COLUMNS)
    elif fmt == "json":
        df = read_json(spark, root, schema=schema)
    else:
        df = read_text(spark, root, None if fmt == "none" else fmt)
    return df.limit(max_rows) if max_rows is not None else df
