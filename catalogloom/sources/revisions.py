"""Immutable revisions: staged write, one visible rename, lineage."""

from __future__ import annotations

import json
import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def revisions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the revisions under ``root``, in order."""
    fs, path = _fs(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"rev=r(\d{3,})", n)))


def next_revision(spark: SparkSession, root: str) -> str:
    return f"r{max(revisions(spark, root), default=0) + 1:03d}"


def check_schema(old: list[str], new: list[str], may_add: list[str], preserve: bool = False) -> None:
    """Columns may be added if named, never lost; ``preserve`` forbids both."""
    lost, added = [c for c in old if c not in new], [c for c in new if c not in old]
    wrong = [c for c in added if preserve or c not in may_add]
    if lost or wrong:
        raise ValueError(f"columns lost: {lost}; not allowed: {wrong}")


def with_columns_after(df: DataFrame, anchor: str, columns: dict) -> DataFrame:
    """``df`` with columns put right behind ``anchor`` (at the end if it is not there); those that stand elsewhere move."""
    rest = [c for c in df.columns if c not in columns]
    at = rest.index(anchor) + 1 if anchor in rest else len(rest)
    made = [F.lit(v).alias(c) if not hasattr(v, "alias") else v.alias(c) for c, v in columns.items()]
    return df.select(*rest[:at], *made, *rest[at:])


def prepared(df: DataFrame, source: list[str], dump_id: str, may_add: list[str] = (), preserve: bool = False) -> DataFrame:
    """A result under the contract of its source's columns: checked, in the source's order with additions behind, ``dump_date`` stamped if it is there."""
    check_schema(source, df.columns, list(may_add), preserve)
    ordered = df.select(*source, *(c for c in df.columns if c not in source))
    return ordered.withColumn("dump_date", F.lit(dump_id)) if "dump_date" in ordered.columns else ordered


def merged_meta(meta: dict, base: str, output: str, stages: list[dict], columns: dict[str, list[str]], reference_year: int | None = None) -> dict:
    """A result's lineage: what its last stage told, whence it comes, its stages and columns; the reference year is the given one, else the source's."""
    from ..operators.status import reference_year as stated

    year = reference_year or stated(meta, datetime.now(timezone.utc).year)
    return meta | {"dump_id": output, "derived_from_dump_id": base, "stages": stages, "pd_reference_year": year} | {f"{k}_columns": v for k, v in columns.items()}


def promote(tables: dict[str, DataFrame], root: str, meta: dict, revision: str | None = None) -> str:
    """Write all tables and the lineage to a staging folder of this call's own, then rename it to the revision; nothing is left on failure."""
    spark = next(iter(tables.values())).sparkSession
    revision = revision or next_revision(spark, root)
    final, staging = f"{root}/rev={revision}", f"{root}/_staging_{revision}_{uuid.uuid4().hex}"
    fs, end = _fs(spark, final)
    _, start = _fs(spark, staging)
    if fs.exists(end):
        raise FileExistsError(final)
    try:
        counts = {}
        for name, df in tables.items():
            df.write.mode("errorifexists").parquet(f"{staging}/{name}")
            counts[name] = spark.read.parquet(f"{staging}/{name}").count()
        stamped = {"dump_id": revision, "created_at_utc": datetime.now(timezone.utc).isoformat(timespec="seconds"), "row_counts": counts} | meta
        out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{staging}/meta.json"), False)
        out.write(bytearray(json.dumps(stamped, sort_keys=True).encode()))
        out.close()
        if not fs.rename(start, end):
            raise OSError(f"{staging} could not be renamed")
    except BaseException:
        fs.delete(start, True)
        raise
    return revision


def read_revision(spark: SparkSession, root: str, revision: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/rev={revision}/{table}")


def read_meta(spark: SparkSession, root: str, revision: str) -> dict:
    return json.loads(spark.read.text(f"{root}/rev={revision}/meta.json").first()[0])


def view_window(today):
    """First and last month of the twelve complete months before ``today`` (a date column)."""
    return F.struct(F.add_months(F.trunc(today, "month"), -12).alias("first"), F.last_day(F.add_months(today, -1)).alias("last"))


def run_stages(base: dict[str, DataFrame], stages: list[tuple[str, object]]) -> dict[str, DataFrame]:
    """Stages of tables -> tables in order, in one lazy plan."""
    for _, stage in stages:
        base = {**base, **stage(base)}
    return base
