"""Files that registered queries read back: zip archives and an inbox, made from the landed record files.

Not part of the readers and sinks: the queries need archives and file names that Spark's
writers do not make.
"""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its file system, so that every machine resolves it alike."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def pack_zip_archives(spark: SparkSession, text_root: str, zip_root: str, *, member_note: str | None = None) -> int:
    """Pack every text part file under ``text_root`` into a zip archive under ``zip_root``; the number of archives.

    One task per part file; folders below the root are kept and the archive is named after
    the part.  A task that runs again writes the same archive again.  ``member_note`` adds a
    second member.
    """
    src, dst = text_root.rstrip("/"), _qualified(spark, zip_root).rstrip("/")
    src_path = urlparse(_qualified(spark, src)).path.rstrip("/")

    def pack(batches):
        import io
        import zipfile

        import pandas as pd
        from pyarrow import fs as pafs

        for pdf in batches:
            made = []
            for path, content in zip(pdf["path"], pdf["content"]):
                stem = urlparse(path).path[len(src_path):].lstrip("/").removesuffix(".txt")
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as z:
                    z.writestr(stem.rsplit("/", 1)[-1] + ".txt", content)
                    if member_note:
                        z.writestr("readme.txt", member_note)
                # Hadoop's s3a/s3n names are plain s3 to Arrow
                uri = f"{dst}/{stem}.zip".replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)
                fsys, p = pafs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))
                fsys.create_dir(p.rsplit("/", 1)[0], recursive=True)
                with fsys.open_output_stream(p) as out:
                    out.write(buf.getvalue())
                made.append(uri)
            yield pd.DataFrame({"archive": made})

    parts = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(src))
    return parts.select("path", "content").mapInPandas(pack, "archive string").count()


def zip_lines(lines: DataFrame, zip_root: str, *, member_note: str | None = None) -> int:
    """Zip archives of the lines (``value``) under ``zip_root``, a folder ``file=...`` for each ``file`` value; the number of archives.

    A task streams its lines into one archive per file, so it holds a batch of them, and names an archive when it is whole.
    A task that runs again writes the same archives again.  ``member_note`` adds a second member.
    """
    dst = _qualified(lines.sparkSession, zip_root).rstrip("/")

    def pack(batches):
        import uuid
        import zipfile

        import pyarrow as pa
        import pyarrow.compute as pc
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        stem, aside = f"part-{TaskContext.get().partitionId():05d}", uuid.uuid4().hex
        # Hadoop's s3a/s3n names are plain s3 to Arrow
        uri = dst.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)
        fsys, root = pafs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))
        made = {}  # file -> its stream, archive and member

        def member(file):
            if file not in made:
                fsys.create_dir(f"{root}/file={file}", recursive=True)
                out = fsys.open_output_stream(f"{root}/file={file}/.{stem}-{aside}")
                archive = zipfile.ZipFile(out, "w", compression=zipfile.ZIP_DEFLATED)
                made[file] = out, archive, archive.open(f"{stem}.txt", "w", force_zip64=True)
            return made[file][2]

        for batch in batches:
            for file in pc.unique(batch["file"]).to_pylist():
                own = batch.filter(pc.equal(batch["file"], file))["value"].to_pylist()
                member(file).write(("\n".join(own) + "\n").encode())
        for file, (out, archive, text) in made.items():
            text.close()
            if member_note:
                archive.writestr("readme.txt", member_note)
            archive.close()
            out.close()
            fsys.move(f"{root}/file={file}/.{stem}-{aside}", f"{root}/file={file}/{stem}.zip")
        yield pa.RecordBatch.from_pydict({"archive": [f"{dst}/file={file}/{stem}.zip" for file in made]}, pa.schema([("archive", pa.string())]))

    return lines.select("value", "file").mapInArrow(pack, "archive string").count()


def inbox(t) -> str:
    """An inbox of record files: loans of every third month zipped, the others in folders, liquidations flat, and two stray files.

    Folders and archives are named like the landed ones; flat files are moved to a name that
    says type and month, one per part.  The lines are rendered into their places from the stored loan-months, which lie by month:
    no line is shuffled or lies there twice.
    """
    from loanlens.plans.catalog_sources import _once, rendering
    from loanlens.session import dropped, scratch_path
    from loanlens.sources import render
    from loanlens.sources.layouts import LL_FIELDS, LR_FIELDS

    spark, path = t.spark, t.landed("inbox_strays")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    unmarked = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}  # the inbox is marked when it is full

    def fill():
        root, aside = jvm.org.apache.hadoop.fs.Path(path), scratch_path(spark, "inbox-flat")
        fs = root.getFileSystem(conf)
        rows = t.loan_months
        with rendering(spark):
            lines = lambda staging, fields: render.to_lines(staging, fields).withColumnRenamed("_file", "file")
            third = F.month("report_date").isin(3, 6, 9, 12)
            lines(render.ll_staging(rows.filter(~third), None), LL_FIELDS).write.mode("overwrite").options(**unmarked).partitionBy("file").text(path)
            zip_lines(lines(render.ll_staging(rows.filter(third), None), LL_FIELDS), path)
            lines(render.lr_staging(rows, None), LR_FIELDS).write.options(**unmarked).partitionBy("file").text(aside)
        for month in fs.listStatus(jvm.org.apache.hadoop.fs.Path(aside)):  # a few files a month
            if month.isDirectory():
                name = month.getPath().getName().removeprefix("file=")
                for i, part in enumerate(p for p in fs.listStatus(month.getPath()) if p.getPath().getName().startswith("part-")):
                    fs.rename(part.getPath(), jvm.org.apache.hadoop.fs.Path(f"{path}/{name}_{i}.txt"))
        dropped(spark, aside)
        for name in ("readme.txt", "old/2001/llmon1_199801.txt"):  # no disclosure file; too far down
            out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
            out.write(bytearray(b"not for loading\n"))
            out.close()
        fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"), True).close()

    return _once(spark, path, fill)
