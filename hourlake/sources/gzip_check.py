"""Which gzip files don't decompress: a Python data source that reads each file as a stream, in pieces.

One partition for each file, so files are verified side by side, and a task holds a piece of the compressed and of the
decompressed bytes at a time, whatever the file's size. Files are opened through Arrow's file systems (local, HDFS, object
stores). Everything a worker needs is inside ``data_source``, so workers need not have this package.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Compressed bytes read at a time, and the most that is decompressed at a time.
PIECE = 1 << 20


def data_source(piece: int = PIECE) -> type[DataSource]:
    """The class to register; options: ``files``, a JSON list of paths."""
    import re
    import zlib
    from urllib.parse import urlparse

    def opened(path: str):
        if urlparse(path).scheme in ("", "file"):
            return open(re.sub(r"^file:/*", "/", path), "rb")
        from pyarrow import fs

        store, place = fs.FileSystem.from_uri(path)
        return store.open_input_stream(place, compression=None)

    def error_of(path: str) -> str | None:
        """Every member of the file is decompressed; what comes out is thrown away."""
        member, seen = zlib.decompressobj(31), False
        with opened(path) as stream:
            while data := stream.read(piece):
                seen = True
                while data:
                    if member.eof:
                        member = zlib.decompressobj(31)
                    try:
                        member.decompress(data, piece)
                    except zlib.error as e:
                        return f"corrupt gzip: {e}"
                    data = member.unused_data if member.eof else member.unconsumed_tail
        return None if member.eof or not seen else "truncated gzip"

    class Reader(DataSourceReader):
        def __init__(self, files: list[str]) -> None:
            self.files = files

        def partitions(self) -> list[InputPartition]:
            return [InputPartition(f) for f in self.files]

        def read(self, partition: InputPartition):
            yield partition.value, error_of(partition.value)

    class GzipCheck(DataSource):
        @classmethod
        def name(cls) -> str:
            return "gzip_check"

        def schema(self) -> str:
            return "path string, error string"

        def reader(self, schema) -> DataSourceReader:
            return Reader(json.loads(self.options["files"]))

    return GzipCheck


def gzip_errors(spark: SparkSession, files: list[str], piece: int = PIECE) -> DataFrame:
    """``path, error`` for each file; the error is null if all of it decompresses."""
    if not files:
        return spark.createDataFrame([], "path string, error string")
    spark.dataSource.register(data_source(piece))
    return spark.read.format("gzip_check").option("files", json.dumps(files)).load()
