"""Daily tables that are rewritten part by part under a versioned manifest.

A table lies in ``path/data/version=<v>/part=<p>/``; ``path/manifest/v=<v>``
names, for every part, the version that holds it. A reader follows the newest
manifest, so it sees a whole table before, during and after a rewrite; a run
that dies leaves no manifest and its repetition overwrites its own folders.
Only the parts (months) that get rows are rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def folder(spark: SparkSession, path: str):
    """(file system, path) of ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    fs, p = folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = folder(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The n of completely written ``path/v=<n>`` folders, rising."""
    names = [n for n in children(spark, path) if n.startswith("v=")]
    return sorted(int(n[2:]) for n in names if "_SUCCESS" in children(spark, f"{path}/{n}"))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict[str, int]:
    """{part: version that holds it} of the newest version, or of the newest
    one up to ``version``. One entry a part, so its size is the calendar's."""
    known = [v for v in versions(spark, f"{path}/manifest") if version is None or v <= version]
    if not known:
        return {}
    rows = spark.read.schema("part string, held long").parquet(f"{path}/manifest/v={known[-1]}").collect()
    return {r.part: r.held for r in rows}


def _read(spark: SparkSession, path: str, schema: T.StructType, held: dict[str, int]) -> DataFrame:
    if not held:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/version={v}/part={p}" for p, v in sorted(held.items())])


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The whole table of the newest manifest (empty if there is none)."""
    return _read(spark, path, schema, manifest(spark, path))


def merge_snapshot(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    keys: list[str],
    order: str,
    part: Column,
    version: int,
    files_per_part: int = 8,
) -> DataFrame:
    """Merge ``rows`` into the table as ``version`` and return the table.

    Of the rows with equal ``keys`` (NULL is a key) the one with the largest
    ``order`` stays, ties going to the larger row. ``part`` is a function of the
    keys; only the parts of ``rows`` are read and written. Merging a version
    again replaces it. Nothing to merge gives a manifest like the last one."""
    schema = rows.schema
    fresh = rows.withColumn("_part", F.coalesce(part, F.lit("none"))).persist()
    try:
        held = manifest(spark, path, version - 1)
        touched = [r[0] for r in fresh.select("_part").distinct().collect()]  # months
        before = _read(spark, path, schema, {p: held[p] for p in touched if p in held})
        both = before.withColumn("_part", F.coalesce(part, F.lit("none"))).unionByName(fresh)
        rest = [c for c in schema.names if c not in (*keys, order)]
        best = both.groupBy("_part", *keys).agg(F.max(F.struct(order, *rest)).alias("_r"))
        out = best.select("_part", *[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in schema.names])
        out = out.repartition("_part", F.pmod(F.xxhash64(*keys), F.lit(files_per_part)))
        out.withColumnRenamed("_part", "part").write.mode("overwrite").partitionBy("part").parquet(f"{path}/data/version={version}")
    finally:
        fresh.unpersist()
    held = {**held, **dict.fromkeys(touched, version)}
    names = spark.createDataFrame(sorted(held.items()), "part string, held long")
    names.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/v={version}")
    return _read(spark, path, schema, held)


def drop_old(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove what no manifest of the last ``keep`` versions names; a reader
    that began under one of these still finds its files."""
    known = versions(spark, f"{path}/manifest")
    used = {(v, p) for n in known[-keep:] for p, v in manifest(spark, path, n).items()}
    for name in children(spark, f"{path}/data"):
        v = int(name.split("=", 1)[1])
        if known and v <= known[-1]:
            parts = [p for p in children(spark, f"{path}/data/{name}") if p.startswith("part=")]
            left = [p for p in parts if (v, p[5:]) in used]
            for p in parts if left else []:
                if p not in left:
                    remove(spark, f"{path}/data/{name}/{p}")
            if not left:
                remove(spark, f"{path}/data/{name}")
    for v in known[:-keep]:
        remove(spark, f"{path}/manifest/v={v}")
