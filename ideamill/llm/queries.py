"""Registered queries of the training-data operators, with SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ideamill.llm import (
    alignment, bpe, exact_dedup, language_model, licenses, merkle, packing, quality, shards, simhash, substrings, token_files, toxicity,
)
from ideamill.llm.common import table
from ideamill.settings import configure, scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return build(table(spark, sf_dir, "documents"), spark, sf_dir)

        run.__name__ = build.__name__
        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return run
    return register


@_query()
def op1_token_files(docs, spark, sf_dir):
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(docs, path, VOCABULARY, end_id=2)
    return token_files.read_documents(token_files.token_files(spark, path)).drop("shard")


@_query()
def op2_karmarkar_karp(docs, spark, sf_dir):
    return shards.shard_documents(docs, 8).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@_query()
def op3_rank_array_bpe(docs, spark, sf_dir):
    return bpe.round_trip_digests(docs, VOCABULARY)


@_query()
def op6_best_fit_packing(docs, spark, sf_dir):
    return packing.packed_documents(docs, VOCABULARY, end_id=1, length=2048)


@_query()
def op4_simhash_bk_trees(docs, spark, sf_dir):
    return simhash.near_duplicate_groups(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@_query("""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op9_counting_quotient_filter(docs, spark, sf_dir):
    return exact_dedup.duplicate_groups(docs)


@_query()
def op5_ftrl_toxicity(docs, spark, sf_dir):
    held_out = toxicity.fold(F.col("doc_id"), 5) == 0
    weights = toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.scored(docs, weights).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query()
def op8_boosted_quality(docs, spark, sf_dir):
    return quality.judged(docs, quality.train(docs, table(spark, sf_dir, "labels"))).drop("chance")


@_query()
def op10_log_bilinear(docs, spark, sf_dir):
    held = F.coalesce(toxicity.fold(F.col("doc_id"), 10) == 0, F.lit(False))
    return language_model.scored(docs.select("doc_id", held.alias("held"), "text"))


@_query()
def op7_suffix_arrays(docs, spark, sf_dir):
    return substrings.removal_digests(docs)


def _sql_leaf(text: str) -> str:
    """The digest of a row's fields in SQL."""
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def _sql_levels(own: str, name: str) -> str:
    """The step from one level of nodes to the next."""
    return f"""SELECT {own} level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
        FROM {name} WHERE n > 1 GROUP BY {own} level, idx // 16, n"""


def _sql_steps(name: str, runs: str, same_tree: str) -> str:
    """The step from a node with its proof so far to the node above it."""
    others = "digests[:idx % 16] || {} digests[idx % 16 + 2:]"
    return f"""SELECT doc_id, leaf, p.tree, place, subroot, idx // 16, (n + 15) // 16, p.level + 1,
            sha256(array_to_string({others.format("[digest] ||")}, '')), proof || array_to_string({others.format("")}, '')
        FROM {name} p JOIN {runs} r ON {same_tree} r.level = p.level AND r.run = p.idx // 16 WHERE n > 1"""


# The bits of the CRC of a decimal number's digits, one after the other.
_SQL_CRC = """xor(4294967295, list_reduce(list_concat([4294967295],
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))))"""


@_query(f"""
    WITH RECURSIVE base AS (SELECT doc_id, source, {_sql_leaf("text")} AS leaf, CASE WHEN doc_id IS NOT NULL AND {_SQL_CRC} % 5 = 0
        THEN {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS probe FROM documents),
    sources AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n FROM base GROUP BY source),
    leaves AS (SELECT base.*, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
        FROM base JOIN sources ON base.source IS NOT DISTINCT FROM sources.source),
    nodes AS (SELECT tree, 0 AS level, idx, n, leaf AS digest FROM leaves UNION ALL {_sql_levels("tree,", "nodes")}),
    top AS (SELECT 0 AS level, tree AS idx, (SELECT count(*) FROM sources) AS n, digest FROM nodes WHERE n = 1
        UNION ALL {_sql_levels("", "top")}),
    runs AS (SELECT tree, level, idx // 16 AS run, list(digest ORDER BY idx) AS digests FROM nodes WHERE n > 1 GROUP BY ALL),
    top_runs AS (SELECT level, idx // 16 AS run, list(digest ORDER BY idx) AS digests FROM top WHERE n > 1 GROUP BY ALL),
    low AS (SELECT doc_id, leaf, leaves.tree, leaves.idx AS place, nodes.digest AS subroot, leaves.idx, leaves.n, 0 AS level,
            coalesce(probe, leaf) AS digest, '' AS proof
        FROM leaves JOIN nodes ON nodes.tree = leaves.tree AND nodes.n = 1
        UNION ALL {_sql_steps("low", "runs", "r.tree = p.tree AND")}),
    high AS (SELECT doc_id, leaf, tree, place, subroot, tree AS idx, (SELECT count(*) FROM sources) AS n, 0 AS level, digest, proof
        FROM low WHERE n = 1 UNION ALL {_sql_steps("high", "top_runs", "")})
    SELECT doc_id, leaf, subroot, top.digest AS root, sha256(proof) AS proof_sha256, high.digest AS folded_root,
        high.digest = top.digest AS verified
    FROM high, top WHERE high.n = 1 AND top.n = 1
""")
def op11_octopus_multiproofs(docs, spark, sf_dir):
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return merkle.audit_digests(docs, tampered)


@_query()
def op12_hash_set_alignment(docs, spark, sf_dir):
    return alignment.alignment_digests(docs, BYTE_LEVEL, PIECES)


@_query()
def op13_license_expressions(docs, spark, sf_dir):
    return licenses.license_digests(docs)
