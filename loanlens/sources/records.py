"""Readers for the delimited multi-record disclosure files, file names and inboxes.

Text is read with Spark's text source (latin-1), one task per file split; the
record type filter, the split on ``|`` and the trimming are column
expressions.  A record with the wrong number of fields fails the job
(``raise_error``), which is what the reference does when a layout changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.clean import blank_null


def read_lines(spark: SparkSession, paths, *, encoding: str = "latin1") -> DataFrame:
    """Raw lines with the file path of each (``value``, ``source``)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = (spark.read.option("encoding", encoding).option("lineSep", "\n").option("recursiveFileLookup", "true")
          .text(paths))
    line = F.when(F.instr("value", "\r") > 0, F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))
    return df.select(line.alias("value"),
                     F.col("_metadata.file_path").alias("source"))


def parse_records(lines: DataFrame, prefix: str, fields, keep=None, *, check: bool = True) -> DataFrame:
    """Keep lines of one record type, split on ``|``, trim, blank -> null, select ``keep`` (default all).

    Two-letter types are known by the start of the line, one-letter types (M, N) by the
    whole first field.  With ``check`` a record whose field count differs from the layout raises.
    """
    fields = list(fields)
    keep = list(keep) if keep else fields
    own = F.col("value").startswith(prefix) if len(prefix) > 1 else F.substring_index("value", "|", 1) == prefix
    rec = lines.filter(own).withColumn("_p", F.split("value", r"\|", -1))
    if check:
        n = len(fields)
        rec = rec.withColumn("_p", F.when(F.size("_p") == n, F.col("_p")).otherwise(
            F.raise_error(F.concat(F.lit("record has "), F.size("_p").cast("string"),
                                   F.lit(f" fields, expected {n}; the file layout may have changed: "),
                                   F.col("source")))))
    cols = [blank_null(F.col("_p").getItem(fields.index(f))).alias(f) for f in keep]
    extra = ["source"] if "source" in lines.columns else []
    return rec.select(*cols, *extra)


def checked_records(lines: DataFrame, prefix: str, fields, *, key: str | None = None) -> DataFrame:
    """Every line of the record type as it is, with what is wrong with it.

    ``bad_reason`` is null for a good line, else ``field count`` or ``no key`` (a blank ``key`` field).  ``line_hash`` is a 64-bit hash
    of the line; ``key`` is a column of its own, null where the line does not have it.
    """
    fields = list(fields)
    own = F.col("value").startswith(prefix) if len(prefix) > 1 else F.substring_index("value", "|", 1) == prefix
    rec = lines.filter(own).withColumn("_p", F.split("value", r"\|", -1))
    reason = F.when(F.size("_p") != len(fields), F.lit("field count"))
    if key:
        rec = rec.withColumn(key, blank_null(F.get("_p", F.lit(fields.index(key)))))
        reason = reason.when(F.col(key).isNull(), F.lit("no key"))
    return rec.select("value", "source", *([key] if key else []), F.xxhash64("value").alias("line_hash"), reason.alias("bad_reason"))


def record_fields(lines: DataFrame, fields, keep=None, *, when: Column | None = None) -> DataFrame:
    """``lines`` with an array ``_g`` of the fields ``keep`` (default all) of ``value``, trimmed, blank -> null; null unless ``when``.

    One array: with an expression per field the method for a row is too long for HotSpot to compile.
    """
    fields, parts = list(fields), F.split("value", r"\|", -1)
    rec = lines.withColumn("_p", parts if when is None else F.when(when, parts))
    some = F.array(*[F.get("_p", F.lit(fields.index(f))) for f in keep]) if keep else F.col("_p")
    return rec.withColumn("_g", F.transform(some, blank_null)).drop("_p")


def split_records(lines: DataFrame, prefix: str, fields, *, key: str | None = None) -> DataFrame:
    """Permissive form of ``parse_records``: ``checked_records`` with a column per field.

    ``bad_line`` is the line itself where there is a ``bad_reason``, and its fields are null.
    """
    rec = checked_records(lines, prefix, fields, key=key)
    good = F.col("bad_reason").isNull()
    rec = record_fields(rec, fields, when=good)
    cols = [F.col("_g").getItem(i).alias(f) for i, f in enumerate(fields)]
    return rec.select(*cols, "source", "line_hash", "bad_reason", F.when(~good, F.col("value")).alias("bad_line"))


def content_digest(line_hash: Column) -> Column:
    """An aggregate that names the lines of a file, whatever their order: count, sum and xor of their hashes."""
    return F.concat_ws("-", F.count(line_hash).cast("string"), F.sum(line_hash.cast("decimal(38,0)")).cast("string"), F.bit_xor(line_hash).cast("string"))


def load_name(path: Column) -> Column:
    """The name that the load log has for a file: its own if that says type and month, else with its folder's before it."""
    name = file_name(path)
    named = name.rlike(r"(?i)^llmon(?:liq)?\d?_\d{6}")
    return F.when(named, name).otherwise(F.regexp_extract(path, r"([^/]+/[^/]+)$", 1))


def read_records(spark: SparkSession, paths, prefix: str, fields, keep=None, **kw) -> DataFrame:
    """One DataFrame of the ``prefix`` records of every file in ``paths``."""
    return parse_records(read_lines(spark, paths, **kw), prefix, fields, keep)


def file_name(path: Column) -> Column:
    """Last path component; cut at the last slash, as a pattern tries every character of a path, for every line."""
    return F.substring_index(path, "/", -1)


def folder_name(path: Column) -> Column:
    """The component before the last one, empty if there is none."""
    none = (file_name(path) == "") | (F.instr(path, "/") == 0)
    return F.when(none, F.lit("")).otherwise(F.substring_index(F.substring_index(path, "/", -2), "/", 1))


def report_month(path: Column, *, override=None) -> Column:
    """Report month from the file name (``llmon1_YYYYMM`` / ``llmonliq1_YYYYMM``) or its folder; null if unknown.

    A file inside a folder named like a disclosure file (an extracted archive)
    takes the folder's month.  ``override`` (a date) wins when given.
    """
    name, parent = file_name(path), folder_name(path)
    pat = r"(?i)^llmon(?:liq)?\d?_(\d{6})"
    ym = F.coalesce(F.nullif(F.regexp_extract(name, pat, 1), F.lit("")),
                    F.nullif(F.regexp_extract(parent, pat, 1), F.lit("")),
                    F.nullif(F.regexp_extract(parent, r"(?i)=llmon(?:liq)?\d?_(\d{6})", 1), F.lit("")))
    d = F.try_to_timestamp(F.concat(ym, F.lit("01")), F.lit("yyyyMMdd")).cast("date")
    return F.coalesce(F.lit(override).cast("date"), d) if override is not None else d


def file_type(path: Column) -> Column:
    """'liquidations' / 'loans' / null from the file name (or the folder it was extracted into)."""
    name = F.concat_ws("/", folder_name(path), file_name(path))
    return (F.when(name.rlike(r"(?i)(?:^|/|=)llmonliq\d?_\d{6}"), "liquidations")
            .when(name.rlike(r"(?i)(?:^|/|=)llmon\d?_\d{6}"), "loans"))


def classify_required(df: DataFrame, path_col: str = "source") -> DataFrame:
    """Add ``file_type`` and ``report_date``; an unrecognised file name fails the job."""
    t = file_type(F.col(path_col))
    return (df.withColumn("file_type", F.when(t.isNotNull(), t).otherwise(
        F.raise_error(F.concat(F.lit("not a recognised disclosure file: "), F.col(path_col)))))
        .withColumn("report_date", report_month(F.col(path_col))))


def list_files(spark: SparkSession, paths) -> DataFrame:
    """(path, length) of every file below ``paths``: a listing, no content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .load([paths] if isinstance(paths, str) else list(paths)).select("path", "length"))


def file_months(spark: SparkSession, paths, *, source: str = "_metadata.file_path") -> DataFrame:
    """(source, report_date, file_type) of every file below ``paths``: a name is read once per file, not once per line.

    Paths are as ``read_lines`` gives them; with ``source`` as ``path`` they are as ``read_zip_members`` does.
    """
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load([paths] if isinstance(paths, str) else list(paths)).select(F.col(source).alias("source")))
    return found.select("source", report_month(F.col("source")).alias("report_date"), file_type(F.col("source")).alias("file_type"))


def inbox_files(spark: SparkSession, base: str) -> DataFrame:
    """Recognised ``.txt``/``.zip`` disclosure files in a folder or one folder down, each once, in path order.

    ``depth`` is 1 for files in the folder itself.  Other files are passed over.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base).toUri().getPath().rstrip("/")
    df = list_files(spark, base)
    inside = F.substring_index(F.col("path"), f"{root}/", -1)
    name = file_name(F.col("path"))
    return (df.withColumn("depth", F.size(F.split(inside, "/")))
            .filter((F.col("depth") <= 2) & F.lower(name).rlike(r"\.(txt|zip)$"))
            .withColumn("file_type", file_type(F.col("path")))
            .filter(F.col("file_type").isNotNull())
            .withColumn("file_name", name)
            .withColumn("report_date", report_month(F.col("path")))
            .orderBy("path"))


ZIP_LIMIT = (1 << 31) - 1024  # bytes of an archive that must be held whole


def read_zip_members(spark: SparkSession, paths, *, encoding: str = "latin-1", batch_lines: int = 65536) -> DataFrame:
    """Lines of the largest member of each zip archive, ``batch_lines`` at a time; an archive is one task.

    Spark's text reader handles gzip natively; zip needs per-archive code.  The archives are listed by Spark and
    opened by seek (``sources.zips``), whatever their size.  In a file system that Arrow cannot open they
    come through the ``binaryFile`` source, whole, and one of 2 GB or more fails with its name.
    An archive without a member fails.
    """
    from urllib.parse import urlparse

    from loanlens.sources import zips

    found = list_files(spark, paths).collect()  # names and sizes of archives
    if {urlparse(r["path"]).scheme for r in found} <= zips.SCHEMES:
        return zips.read_archives(spark, [r["path"] for r in found], encoding=encoding, batch_lines=batch_lines)
    large = [r["path"] for r in found if r["length"] > ZIP_LIMIT]
    if large:
        raise ValueError(f"{large[0]} is too large to be read whole; extract it first")
    return _whole_archives(spark, [r["path"] for r in found], encoding, batch_lines)


def _whole_archives(spark: SparkSession, paths: list[str], encoding: str, batch_lines: int) -> DataFrame:
    import io
    import zipfile

    import pandas as pd

    def explode(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                z = zipfile.ZipFile(io.BytesIO(content))
                members = [m for m in z.infolist() if not m.is_dir()]
                if not members:
                    raise ValueError(f"{path} is an empty zip file")
                out = []
                with io.TextIOWrapper(z.open(max(members, key=lambda m: m.file_size)), encoding=encoding, newline="\n") as fh:
                    for ln in fh:
                        ln = ln.rstrip("\n").rstrip("\r")
                        if ln:
                            out.append(ln)
                        if len(out) >= batch_lines:
                            yield pd.DataFrame({"value": out, "source": path})
                            out = []
                if out:
                    yield pd.DataFrame({"value": out, "source": path})

    raw = spark.read.format("binaryFile").load(paths)
    return raw.select("path", "content").mapInPandas(explode, "value string, source string")
