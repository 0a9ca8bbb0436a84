"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tickcast.llm.alignment import op13_alignment
from tickcast.llm.bpe import op5_bpe
from tickcast.llm.collocations import OP11, op11_collocations
from tickcast.llm.hyperminhash import op7_hyperminhash
from tickcast.llm.language import op10_string_kernel
from tickcast.llm.licenses import op9_license_scan
from tickcast.llm.order_minhash import op12_order_minhash
from tickcast.llm.packing import op3_best_fit_packing
from tickcast.llm.pii import op8_skip_chain
from tickcast.llm.quality import op2_divergence_rules
from tickcast.llm.sharding import op4_label_propagation
from tickcast.llm.suffix_dedup import op1_suffix_dedup
from tickcast.llm.topk import op6_norm_buckets

OP6 = """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 20
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_divergence_rules": op2_divergence_rules,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_label_propagation": op4_label_propagation,
        "op5_bpe": op5_bpe,
        "op6_norm_buckets": op6_norm_buckets,
        "op7_hyperminhash": op7_hyperminhash,
        "op8_skip_chain": op8_skip_chain,
        "op9_license_scan": op9_license_scan,
        "op10_string_kernel": op10_string_kernel,
        "op11_collocations": op11_collocations,
        "op12_order_minhash": op12_order_minhash,
        "op13_alignment": op13_alignment,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    sql = {"op6_norm_buckets": OP6, "op11_collocations": OP11}
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
