"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pawnshop.session import checkpoint_dir, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later uses don't compute it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def text_of(column: str = "text"):
    """A text column; null counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def file_store(uri: str):
    """(pyarrow file system, path) of a place in the shared folder; works from any executor."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def put_file(uri: str, data: bytes) -> None:
    """Write a whole file under another name and move it: a file that is there is complete, whoever wrote it."""
    import uuid

    store, path = file_store(uri)
    store.create_dir(path.rpartition("/")[0])
    part = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        f.write(data)
    store.move(part, path)


def map_file(uri: str):
    """The file as read-only mapped memory: in place if the shared folder is mounted, else from a nameless local copy."""
    import mmap
    import shutil
    import tempfile

    from pyarrow import fs

    store, path = file_store(uri)
    if isinstance(store, fs.LocalFileSystem):
        with open(path, "rb") as f:
            return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    with tempfile.TemporaryFile() as f:
        with store.open_input_stream(path) as src:
            shutil.copyfileobj(src, f)
        f.flush()
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
