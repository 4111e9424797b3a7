"""The registered queries of this package, with production parameters over whole tables."""

from __future__ import annotations


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark, sf_dir):
    from lexforge.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op4_token_files(spark, sf_dir):
    from lexforge.llm.token_files import token_files

    return token_files(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op8_token_counts(spark, sf_dir):
    import public_tokenizers

    from lexforge.llm.token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op2_url_filter(spark, sf_dir):
    from lexforge.llm.url_filter import url_filter

    return url_filter(_table(spark, sf_dir, "pages"))


def op9_secret_scan(spark, sf_dir):
    from lexforge.llm.secrets import secret_scan

    return secret_scan(_table(spark, sf_dir, "documents"))


def op6_ngram_join(spark, sf_dir):
    from lexforge.llm.ngram_join import ngram_join

    return ngram_join(_table(spark, sf_dir, "documents"), 4, 85)


def op7_embedding_dedup(spark, sf_dir):
    from lexforge.llm.embedding_dedup import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op10_quality(spark, sf_dir):
    from lexforge.llm.quality import quality_scores

    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark, sf_dir):
    from lexforge.llm.suffix_dedup import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark, sf_dir):
    from lexforge.llm.decontaminate import leaks

    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries():
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql():
    return {}
