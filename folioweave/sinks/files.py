"""Rows as files of their own: crops by class, pictures of the steps, grid overlays."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_files(df: DataFrame, folder: str, path: str = "path", data: str = "data") -> None:
    """Each row's bytes to its path below folder (a local shared path or a URI that Arrow's file systems open).

    Files are written where the rows are, under a name of the attempt's own, and then moved, so a
    task that is lost or runs twice leaves no half file. Rows with null bytes are left out.
    """

    def write(rows) -> None:
        import os
        import uuid

        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(folder)
        for row in rows:
            target = f"{base}/{row[0]}"
            fs.create_dir(os.path.dirname(target), recursive=True)
            own = f"{target}.{uuid.uuid4().hex}"
            with fs.open_output_stream(own) as out:
                out.write(bytes(row[1]))
            fs.move(own, target)

    df.where(F.col(data).isNotNull() & F.col(path).isNotNull()).select(path, data).foreachPartition(write)


def archive_crops(done: DataFrame, document: str, out: str) -> None:
    """Classified crops as normal/<document>/<name> and deleted/<document>/<name> below out.

    Both folders of this document are emptied first; other documents' stay. Crops without a class are left out.
    """
    import os

    spark, out = done.sparkSession, out if "://" in out else os.path.abspath(out)
    for kind in ("normal", "deleted"):
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{kind}/{document}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    kind = F.when(F.col("deleted"), "deleted").otherwise("normal")
    write_files(done.where("status = 'ok'").select(F.concat_ws("/", kind, F.lit(document), "name").alias("path"), F.col("png").alias("data")), out)
