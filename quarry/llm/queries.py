"""The operators applied to whole tables with production parameters, and their SQL."""

from __future__ import annotations

from ..sources.tables import table
from . import bytepair, decontaminate, hardneg, langid, mixing, neardup, recompression, suffix_index, suffix_tree, toxicity, vptree, warc, whitening
from .tables import documents


def op1_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(documents(spark, sf_dir))


def op2_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_decontaminate(spark, sf_dir):
    return decontaminate.decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op4_recompression(spark, sf_dir):
    return recompression.remove(documents(spark, sf_dir))


def op5_suffix_tree(spark, sf_dir):
    return suffix_tree.score_held_out(documents(spark, sf_dir))


def op6_nearest(spark, sf_dir):
    return vptree.neighbours(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op7_toxicity(spark, sf_dir):
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op8_language(spark, sf_dir):
    return langid.identify(documents(spark, sf_dir, "doc_id", "text", "lang"))


def op9_suffix_index(spark, sf_dir):
    return suffix_index.remove(documents(spark, sf_dir))


def op10_mixing(spark, sf_dir):
    mixed = mixing.mix_sources(documents(spark, sf_dir, "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_byte_bpe(spark, sf_dir):
    import public_tokenizers

    ranks = bytepair.read_ranks(public_tokenizers.path(bytepair.VOCABULARY))
    return bytepair.round_trip(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op13_hard_negatives(spark, sf_dir):
    return hardneg.mine(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_warc": op2_warc,
    "op3_decontaminate": op3_decontaminate,
    "op4_recompression": op4_recompression,
    "op5_suffix_tree": op5_suffix_tree,
    "op6_nearest": op6_nearest,
    "op7_toxicity": op7_toxicity,
    "op8_language": op8_language,
    "op9_suffix_index": op9_suffix_index,
    "op10_mixing": op10_mixing,
    "op11_whitening": op11_whitening,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL = {
    "op2_warc": warc.ORACLE_SQL,
    "op3_decontaminate": decontaminate.ORACLE_SQL,
    "op6_nearest": vptree.ORACLE_SQL,
    "op10_mixing": mixing.ORACLE_SQL,
    "op13_hard_negatives": hardneg.ORACLE_SQL,
}
