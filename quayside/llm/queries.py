"""Queries of this package by name, and their DuckDB forms where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.llm.op10_suffixes import op10_suffixes
from quayside.llm.op11_treap import op11_treap
from quayside.llm.op12_forest import op12_forest
from quayside.llm.op13_manifest import op13_manifest
from quayside.llm.op1_minhash import op1_minhash
from quayside.llm.op2_cover_tree import op2_cover_tree
from quayside.llm.op3_decontaminate import op3_decontaminate
from quayside.llm.op4_mixing import op4_mixing
from quayside.llm.op5_token_files import op5_token_files
from quayside.llm.op6_token_counts import op6_token_counts
from quayside.llm.op7_passages import op7_passages
from quayside.llm.op8_quality import op8_quality
from quayside.llm.op9_mix import op9_mix
from quayside.llm.workers import with_workers

OPERATORS = (
    *(op1_minhash, op2_cover_tree, op3_decontaminate, op4_mixing, op5_token_files, op6_token_counts, op7_passages),
    *(op8_quality, op9_mix, op10_suffixes, op11_treap, op12_forest, op13_manifest),
)

#: The search's ranking is exact, so SQL can say it; the other operators' results it can't express, or not on whole tables.
OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
every AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, every GROUP BY term, docs
), scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), every GROUP BY item_id, doc_id
), ranks AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranks WHERE rank <= 10
"""


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: with_workers(f) for f in OPERATORS}


def llm_sql() -> dict[str, str]:
    return {"op11_treap": OP11_SQL}
