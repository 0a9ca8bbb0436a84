"""Language identification by a string kernel.

A text's blended spectrum is the set of its lower-case 1- to 3-grams (every
stretch of other signs is one blank), as a bit map of 2**15 hashed places. The
kernel of two texts is the cosine of their sets. Landmark texts give a Nyström
map, and one ridge regression for each language is fitted on it. Scoring
multiplies a batch's bit maps by the landmarks' in one matrix product.

Training takes every language, with at most TRAIN_PER_LANG labelled rows of
each (the smallest text hashes); every text is read whole. The regressions are
fitted from sums over the rows, taken where the rows are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickcast.llm.bpe import LETTER, classes
from tickcast.llm.common import U64, arrow_settings, drop_stage, mix, stage

BITS = 15
TRAIN_PER_LANG = 200
LANDMARKS_PER_LANG = 24
LANDMARKS = 1536  # of all languages together; where they don't suffice each language has fewer
ROWS = 64  # rows of the sum of products in one row of a table
RIDGE = 1e-2
BATCH = 64  # texts in one matrix product


def spectra(texts: list[str | None], bits: int = BITS) -> np.ndarray:
    """Bit maps (texts x 2**bits, bool) of the n-grams present; a text without
    letters has none."""
    lower = [(t or "").lower() for t in texts]
    out = np.zeros((len(texts), 1 << bits), bool)
    joined = "".join(lower)
    if not joined:
        return out
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.arange(len(lower)), [len(t) for t in lower])
    letter = classes()[cps] == LETTER
    new = np.append(True, row[1:] != row[:-1])
    keep = letter | np.append(True, letter[:-1]) | new  # one blank for each other stretch
    sym, row, letter = np.where(letter, cps, 32)[keep].astype(U64), row[keep], letter[keep]
    has = np.zeros(len(texts), bool)
    has[row[letter]] = True
    with np.errstate(over="ignore"):
        code, alive = np.zeros(len(sym), U64), np.ones(len(sym), bool)
        for n in range(3):
            if len(sym) <= n:
                break
            code = code[: len(sym) - n] * U64(0x9E3779B97F4A7C15) + sym[n:] + U64(1)
            alive = row[n:] == row[: len(sym) - n]
            place = (mix(code + U64(n)) >> U64(64 - bits)).astype(np.int64)
            at = row[: len(sym) - n]
            alive &= has[at]
            out[at[alive], place[alive]] = True
    return out


def packed_spectra(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        maps = [np.packbits(spectra(texts[i : i + BATCH]), axis=1) for i in range(0, len(texts), BATCH)]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([x.tobytes() for m in maps for x in m], pa.binary())], names=["lang", "bits"])


class LanguageModel:
    """Nyström map and one-versus-rest ridge regressions over landmarks."""

    def __init__(self, langs: list[str], bits: np.ndarray, landmarks: np.ndarray, weights: np.ndarray):
        self.langs, self.bits, self.weights = langs, bits, weights  # bits: packed landmark maps
        self.landmarks = landmarks

    @classmethod
    def fit(cls, sample: DataFrame, ridge: float = RIDGE) -> LanguageModel:
        """The model of the packed maps in ``sample`` (lang, bits)."""
        packed = landmark_maps(sample)
        marks = np.array([np.frombuffer(x, np.uint8) for x in packed])
        low = np.unpackbits(marks, axis=1).astype(np.float32)
        value, vector = np.linalg.eigh(cls.kernel(low, low))
        good = value > 1e-6 * value.max()
        root = vector[:, good] / np.sqrt(value[good])
        size = root.shape[1]
        got = sample.mapInArrow(products(marks, root), "lang string, at int, n long, total binary")
        got = got.groupBy("lang", "at").applyInArrow(summed, "lang string, at int, n long, total binary").collect()
        gram = np.concatenate([np.frombuffer(r.total).reshape(-1, size) for r in sorted((r for r in got if r.lang is None), key=lambda r: r.at)])
        own = sorted((r for r in got if r.lang is not None), key=lambda r: r.lang)
        n = sum(r.n for r in own)
        solved = np.linalg.solve(gram + ridge * n * np.eye(size), np.array([np.frombuffer(r.total) for r in own]).T)
        return cls([r.lang for r in own], marks, low, root @ solved)

    @staticmethod
    def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        size = np.sqrt(np.maximum(a.sum(1), 1))[:, None] * np.sqrt(np.maximum(b.sum(1), 1))
        return ((a @ b.T) / size).astype(np.float64)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if self.landmarks is None:
            self.landmarks = np.unpackbits(self.bits, axis=1).astype(np.float32)
        names, scores = [], []
        for i in range(0, len(texts), BATCH):
            maps = spectra(texts[i : i + BATCH]).astype(np.float32)
            value = self.kernel(maps, self.landmarks) @ self.weights
            best = value.argmax(1)
            empty = maps.sum(1) == 0
            names += ["und" if e else self.langs[b] for b, e in zip(best, empty)]
            scores.append(np.where(empty, 0.0, np.clip(value[np.arange(len(best)), best], 0, 1)))
        return names, np.concatenate(scores) if scores else np.zeros(0)

    def __getstate__(self):
        return self.__dict__ | {"landmarks": None}  # workers unpack the bits


def landmark_maps(sample: DataFrame) -> list[bytes]:
    """LANDMARKS_PER_LANG packed maps of each language, fewer if they are
    more than LANDMARKS; every language has one before any has two."""
    first = sample.withColumn("i", F.row_number().over(W.partitionBy("lang").orderBy("bits"))).filter(F.col("i") <= LANDMARKS_PER_LANG)
    got = first.orderBy("i", F.xxhash64("bits"), "lang").limit(LANDMARKS).collect()
    return [bytes(r.bits) for r in sorted(got, key=lambda r: (r.lang, r.i))]


def products(marks: np.ndarray, root: np.ndarray):
    """mapInArrow: packed maps -> sums of phi'phi (lang null, ROWS rows each)
    and of phi'y (one row a language) of the batches."""

    def run(batches):
        low = np.unpackbits(marks, axis=1).astype(np.float32)
        gram, own = np.zeros((root.shape[1],) * 2), {}
        for batch in batches:
            langs, bits = batch.column("lang").to_pylist(), batch.column("bits").to_pylist()
            for i in range(0, len(bits), BATCH):
                maps = np.unpackbits(np.array([np.frombuffer(x, np.uint8) for x in bits[i : i + BATCH]]), axis=1).astype(np.float32)
                phi = LanguageModel.kernel(maps, low) @ root
                gram += phi.T @ phi
                for lang, x in zip(langs[i : i + BATCH], phi):
                    n, total = own.get(lang, (0, 0.0))
                    own[lang] = n + 1, total + x
        if own:
            for i in range(0, len(gram), ROWS):
                yield sums([(None, i, 0, gram[i : i + ROWS])])
            rows = [(lang, 0, n, total) for lang, (n, total) in own.items()]
            for i in range(0, len(rows), ROWS):
                yield sums(rows[i : i + ROWS])

    return run


def sums(rows: list[tuple]) -> pa.RecordBatch:
    lang, at, n, total = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(at, pa.int32()), pa.array(n, pa.int64()), pa.array([x.tobytes() for x in total], pa.binary())], names=["lang", "at", "n", "total"])


def summed(table: pa.Table) -> pa.Table:
    """applyInArrow: the sum of the rows of one (lang, at)."""
    total = np.sum([np.frombuffer(x) for x in table.column("total").to_pylist()], axis=0)
    row = (table.column("lang")[0].as_py(), table.column("at")[0].as_py(), sum(table.column("n").to_pylist()), total)
    return pa.Table.from_batches([sums([row])])


def train(docs: DataFrame) -> LanguageModel | None:
    """A model of the rows (text, lang) with both present, on the bounded sample."""
    rows = docs.filter("lang is not null and text is not null").select("lang", "text")
    ids = rows.filter(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    edge = ids.select("lang", "h").distinct()
    for parts in (256, 32, 4, 1):  # a frequent language is cut down in parts, of 8 x TRAIN_PER_LANG rows at most after the first cut
        order = W.partitionBy("lang", F.pmod("h", F.lit(parts))).orderBy("h")
        edge = edge.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= TRAIN_PER_LANG).drop("i")
    cut = stage(edge.groupBy("lang").agg(F.max("h").alias("last")), "cut")
    sample = ids.join(F.broadcast(cut), "lang").filter(F.col("h") <= F.col("last")).select("lang", "text").dropDuplicates(["lang", "text"])
    sample = stage(sample.mapInArrow(packed_spectra, "lang string, bits binary"), "sample")
    model = LanguageModel.fit(sample) if sample.limit(1).count() else None
    drop_stage(cut)
    drop_stage(sample)
    return model


def predictions(model: LanguageModel | None):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = model.predict(texts) if model else (["und"] * len(texts), np.zeros(len(texts)))
            cols = [batch.column(n) for n in batch.schema.names] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` (every column kept; one named lang_pred or score is replaced)
    with lang_pred and score. A null text, or one without letters, is ``und``
    with score 0; without a model every text is."""
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(predictions(model), schema)


def held_out() -> F.Column:
    """True for a fifth of the ids, by crc32 of the id as text; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op10_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    with arrow_settings(spark):
        model = train(docs.filter(~held_out() & F.col("doc_id").isNotNull()))
        rows = identify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
        return stage(rows.select("doc_id", held_out().alias("held_out"), "lang_pred", "score"), "op10")
