"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    A local session that names none, as in tests, gets a temporary folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named is None and sc.getCheckpointDir() is None and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="catalogloom-"))
    return named or sc.getCheckpointDir()


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of queries that are over (it follows the driver's garbage collection)."""
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: the lineage ends there."""
    release(df.sparkSession)
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/catalogloom/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a frame made by ``cut`` that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text; a null text is an empty one. Other columns, whatever their names, go."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def pressed(texts: list) -> list[bytes | None]:
    """Texts compressed, for a shuffle; null stays."""
    press = zstandard.ZstdCompressor(level=3, write_checksum=False).compress
    return [None if t is None else press(t.encode("utf-8", "surrogatepass")) for t in texts]


def unpressed(column: list) -> list[bytes | None]:
    open_ = zstandard.ZstdDecompressor().decompress
    return [None if z is None else open_(z) for z in column]


def sliced(batches, rows: int = 10_000, size: int = 4 << 20):
    """Batches of at most ``rows`` rows and about ``size`` bytes of text (one row at least), so that few are Python values at once."""
    for b in batches:
        length = np.zeros(b.num_rows, np.int64)
        for c in b.columns:
            if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
                length += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
        upto, lo = np.cumsum(length), 0
        while lo < b.num_rows:
            full = int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + size, "right"))
            hi = min(b.num_rows, lo + rows, max(lo + 1, full))
            yield b.slice(lo, hi - lo)
            lo = hi


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str, rows: int = 10_000) -> DataFrame:
    """Apply ``fn`` to each Arrow batch, at most ``rows`` at once; ``fn`` yields dicts of columns in the order of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for b in sliced(batches, rows):
            for columns in fn(b):
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def with_columns(df: DataFrame, text_col: str, fn: Callable[[list], dict], schema: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """``df`` with further columns made from its text column; ``fn`` gets a batch's texts (null: empty).

    A new name that ``df`` has already gets underscores; the names used are returned too.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    taken = {c.lower() for c in df.columns}
    names = []
    for name in schema:
        while name.lower() in taken:
            name += "_"
        names.append(name)
        taken.add(name.lower())
    new = StructType([StructField(n, _parse_datatype_string(t)) for n, t in zip(names, schema.values(), strict=True)])
    out = StructType([*df.schema.fields, *new.fields])
    arrow = to_arrow_schema(new)

    def run(batches):
        for b in sliced(batches):
            made = fn([t or "" for t in b.column(text_col).to_pylist()])
            fresh = [pa.array(made[k], type=f.type) for k, f in zip(schema, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, *fresh], names=[*b.schema.names, *names])

    return df.mapInArrow(run, out), names
