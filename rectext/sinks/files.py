"""Write text lines into files whose names come from a column.

Spark's own writers choose part-file names; inputs such as ``a.JSON`` or
``sub/b.ndjson`` need chosen names. Rows are hash-partitioned by file name
and each task streams its files out through Arrow's file system layer (local,
HDFS or S3 alike). A task writes whole files from scratch, so a retried or
speculative task rewrites the same bytes.

A file is one writer by nature, so callers choose names that bound a file
(for example one file per source and chunk).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of texts that a writer joins at once (one longer text goes by itself).
WRITE_BYTES = 4 << 20


def _arrow_fs(uri: str):
    import pyarrow.fs as pafs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def write_named_lines(df: DataFrame, root: str, name_col: str = "name", value_col: str = "value",
                      order_cols: list[str] | None = None, num_partitions: int | None = None,
                      header: str = "", separator: str = "\n", footer: str = "\n") -> DataFrame:
    """Write the ``value_col`` texts of each ``name_col`` into ``root/<name>``:
    ``header``, the texts joined by ``separator`` (in ``order_cols`` order),
    ``footer``. The defaults give one line per value; ``"[\n"``, ``",\n"``,
    ``"\n]\n"`` give a JSON array. Returns a lazy DataFrame ``name, n_lines``
    (one row per file); run an action on it to write (it is small)."""
    # A root without scheme lies in the cluster's default file system, as Spark's readers take it.
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
    root = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    order_cols = order_cols or []
    parts = df.repartition(num_partitions, name_col) if num_partitions else df.repartition(name_col)
    parts = parts.sortWithinPartitions(name_col, *order_cols).select(
        F.col(name_col).alias("name"), F.col(value_col).alias("value"))

    ddl = "name string, n_lines long"
    out, glue = to_arrow_schema(T._parse_datatype_string(ddl)), separator.encode("utf-8")

    def write(batches):
        import posixpath

        import numpy as np
        import pyarrow as pa
        fs, base = _arrow_fs(root)
        cur, stream, n = None, None, 0
        done: list = []

        def close():
            stream.write(footer.encode("utf-8"))
            stream.close()
            done.append((cur, n))

        for batch in batches:
            names = batch.column("name").dictionary_encode()
            at, known = names.indices.fill_null(-1).to_numpy(zero_copy_only=False), names.dictionary.to_pylist()
            values = batch.column("value").cast(pa.large_binary())
            sizes = np.diff(np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1])
            starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else at
            for start, end in zip(starts, [*starts[1:], len(at)]):
                if at[start] < 0:                  # a row without a name belongs to no file
                    continue
                if known[at[start]] != cur:
                    if stream is not None:
                        close()
                    cur, n = known[at[start]], 0
                    target = posixpath.join(base, cur)
                    fs.create_dir(posixpath.dirname(target), recursive=True)
                    stream = fs.open_output_stream(target)
                    stream.write(header.encode("utf-8"))
                # A few MB at a time are copied, whatever a batch holds.
                part = (np.cumsum(sizes[start:end]) - sizes[start:end]) // WRITE_BYTES
                cuts = start + np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                for i, j in zip(cuts, [*cuts[1:], end]):
                    text = glue.join(x or b"" for x in values[i:j].to_pylist())
                    stream.write((glue if n else b"") + text)
                    n += int(j - i)
        if stream is not None:
            close()
        yield pa.RecordBatch.from_pydict({"name": [x for x, _ in done], "n_lines": [x for _, x in done]}, schema=out)

    return parts.mapInArrow(write, ddl)
