"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from ambry.llm import (boosted_quality, decontaminate, hash_tree, huffman_ids, line_index, merkle, signature_tree, skip_chain_pii,
                       small_world, source_mix, string_kernel, threshold_join, warc_revisit)
from ambry.llm.common import table


def op1_warc_revisits(spark, sf_dir):
    return warc_revisit.revisit_report(table(spark, sf_dir, "pages"))


def op2_simhash_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_hash_tree_shards(spark, sf_dir):
    return hash_tree.shard_documents(table(spark, sf_dir, "documents"))


def op9_source_mix(spark, sf_dir):
    return source_mix.mix_digest(table(spark, sf_dir, "documents"))


def op10_string_kernel_language(spark, sf_dir):
    return string_kernel.language_digest(table(spark, sf_dir, "documents"))


def op4_huffman_token_ids(spark, sf_dir):
    import public_tokenizers
    return huffman_ids.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_skip_chain_pii(spark, sf_dir):
    return skip_chain_pii.personal_data_digest(table(spark, sf_dir, "documents"))


def op6_line_index_dedup(spark, sf_dir):
    return line_index.line_digest(table(spark, sf_dir, "documents"))


def op7_signature_tree_join(spark, sf_dir):
    return signature_tree.near_duplicates(table(spark, sf_dir, "documents"))


def op8_boosted_quality(spark, sf_dir):
    return boosted_quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_small_world_neighbours(spark, sf_dir):
    return small_world.neighbour_report(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest_digest(table(spark, sf_dir, "documents"))


def op13_threshold_hard_negatives(spark, sf_dir):
    return threshold_join.hard_negative_report(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_warc_revisits, op2_simhash_decontamination, op3_hash_tree_shards, op4_huffman_token_ids, op5_skip_chain_pii,
    op6_line_index_dedup, op7_signature_tree_join, op8_boosted_quality, op9_source_mix, op10_string_kernel_language,
    op11_small_world_neighbours, op12_merkle_manifest, op13_threshold_hard_negatives)}
ORACLE = {"op1_warc_revisits": warc_revisit.SQL, "op6_line_index_dedup": line_index.SQL, "op9_source_mix": source_mix.SQL,
          "op12_merkle_manifest": merkle.SQL, "op13_threshold_hard_negatives": threshold_join.SQL}
