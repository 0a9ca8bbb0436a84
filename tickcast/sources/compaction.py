"""Compaction of a document collection (S10) while it is read and written.

Loads and micro-batches leave small files in every ``index=<symbol>`` folder.
:func:`compact_documents` rewrites them into a run, ``path/_compacted/data/run=<v>``,
and then writes ``path/_compacted/manifest/v=<v>``, which names the live runs and
what they replace: micro-batches up to a number, or the files of loads. A reader
takes the runs of the newest manifest and whatever of the collection it does not
replace, so it sees every document once before, during and after a compaction.

Runs grow geometrically: a run is rewritten only with at least half as many
newer rows, so n compactions leave about log2(n) runs and rewrite a document as
often. Replaced files stay until the next compaction begins, for readers that
planned under the manifest before. One compaction runs at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickcast.sources.snapshots import children, folder, remove, versions

MANIFEST = "run long, n_rows long, upto long, file string"


@dataclass
class Compacted:
    """What the newest manifest says; version 0 if there is none."""

    version: int = 0
    runs: dict[int, int] = field(default_factory=dict)  # run: rows
    upto: int | None = None  # micro-batches up to this one are in the runs
    files: list[str] = field(default_factory=list)  # files of loads that are in the runs


def compacted(spark: SparkSession, path: str) -> Compacted:
    known = versions(spark, f"{path}/_compacted/manifest")
    if not known:
        return Compacted()
    # one row a run and a file replaced since the last compaction
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/_compacted/manifest/v={known[-1]}").collect()
    upto = max((r.upto for r in rows if r.upto is not None), default=None)
    return Compacted(known[-1], {r.run: r.n_rows for r in rows if r.run is not None}, upto, [r.file for r in rows if r.file])


def _runs(spark: SparkSession, path: str, runs: list[int], fmt: str) -> DataFrame:
    paths = [f"{path}/_compacted/data/run={r}" for r in sorted(runs)]
    reader = spark.read.format(fmt).option("basePath", f"{path}/_compacted/data")
    found = reader.load(paths).schema
    # symbols may look like numbers in the folder names
    typed = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "index" else f for f in found.fields])
    return reader.schema(typed).load(paths).drop("run")


def _loaded(spark: SparkSession, path: str, fmt: str, schema: str | T.StructType | None) -> DataFrame:
    reader = spark.read.format(fmt)
    docs = (reader.schema(schema) if schema is not None else reader).load(path)
    return docs.withColumn("_batch", F.col("_batch").cast("long")) if "_batch" in docs.columns else docs


def _fresh(docs: DataFrame, state: Compacted) -> DataFrame:
    """The documents that no run holds; both filters act on the file listing."""
    if state.upto is not None:
        docs = docs.filter(F.col("_batch") > state.upto)
    return docs.filter(~F.col("_metadata.file_path").isin(state.files)) if state.files else docs


def load_documents(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """All document rows of a collection, ``_load`` and ``_batch`` included."""
    state = compacted(spark, path)
    if not state.runs:
        return _loaded(spark, path, fmt, schema)
    runs = _runs(spark, path, list(state.runs), fmt)
    docs = _fresh(_loaded(spark, path, fmt, runs.schema), state).unionByName(runs)
    if schema is None:
        return docs
    wanted = T.StructType.fromDDL(schema).names
    return docs.select(*wanted, *[c for c in ("_batch",) if c in docs.columns and c not in wanted])


def newest(docs: DataFrame) -> DataFrame:
    """The newest load of each (symbol, date): one aggregate, partial map-side.
    Rows without a load number are all kept."""
    if "_load" not in docs.columns:
        return docs
    order = F.struct("_load", "_batch") if "_batch" in docs.columns else F.col("_load")
    rest = [c for c in docs.columns if c not in ("symbol", "date")]
    latest = docs.groupBy("symbol", "date").agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return latest.select(*[F.col(c) if c in ("symbol", "date") else F.col(f"_r.{c}").alias(c) for c in docs.columns])


def _drop_replaced(spark: SparkSession, path: str, state: Compacted) -> None:
    """Delete what the newest manifest replaces, and runs that it doesn't name.
    No reader of that manifest looks at them, so a repetition does no harm."""
    for run in children(spark, f"{path}/_compacted/data"):
        if int(run[4:]) not in state.runs:
            remove(spark, f"{path}/_compacted/data/{run}")
    for file in state.files:
        uri = spark._jvm.java.net.URI(file)
        at = spark._jvm.org.apache.hadoop.fs.Path(uri)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, False)
    if state.upto is not None:
        for index in [n for n in children(spark, path) if n.startswith("index=")]:
            for name in [n for n in children(spark, f"{path}/{index}") if n.startswith("_batch=")]:
                if int(name[7:]) <= state.upto:
                    remove(spark, f"{path}/{index}/{name}")
    for v in versions(spark, f"{path}/_compacted/manifest"):
        if v < state.version:
            remove(spark, f"{path}/_compacted/manifest/v={v}")


def compact_documents(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """Compact what was written since the last compaction; returns the version
    of the newest manifest (0: nothing to compact yet).

    Of upserted documents only the newest load of a (symbol, date) is kept.
    The last micro-batch stays as it is: it may be written once more. Loads and
    micro-batches written meanwhile are left to the next compaction. An empty
    or missing collection is left alone; a failed compaction is done again."""
    fs, at = folder(spark, path)
    if not fs.exists(at) or not [n for n in children(spark, path) if n.startswith("index=")]:
        return 0
    state = compacted(spark, path)
    if state.version:
        _drop_replaced(spark, path, state)
    schema = _runs(spark, path, list(state.runs), fmt).schema if state.runs else None
    docs = _fresh(_loaded(spark, path, fmt, schema), state)
    upto, files = state.upto, []
    if "_batch" in docs.columns:
        last = docs.agg(F.max("_batch").alias("last")).first().last
        upto = state.upto if last is None else last - 1
        docs = docs.filter(F.col("_batch") <= (-1 if upto is None else upto))
    else:
        # files listed here and read below are those of one and the same frame
        files = [r[0] for r in docs.select("_metadata.file_path").distinct().collect()]
    size = docs.count()
    if not size:
        return state.version
    merged = []
    for run in sorted(state.runs, reverse=True):
        if state.runs[run] > 2 * size:
            break
        merged.append(run)
        size += state.runs[run]
    version = state.version + 1
    out = docs.unionByName(_runs(spark, path, merged, fmt)) if merged else docs
    # a writer task a symbol, more for one of many documents
    out = newest(out).hint("rebalance", F.col("index"))
    target = f"{path}/_compacted/data/run={version}"
    out.write.mode("overwrite").partitionBy("index").format(fmt).save(target)
    runs = {r: n for r, n in state.runs.items() if r not in merged}
    runs[version] = spark.read.format(fmt).load(target).count()
    rows = [(r, n, None, None) for r, n in sorted(runs.items())] + [(None, None, upto, None)] + [(None, None, None, f) for f in files]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/_compacted/manifest/v={version}")
    return version
