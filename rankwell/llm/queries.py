"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankwell.llm import ann, bpe, collocations, cotrain, decontamination, htmldiff, iblt, licenses, mixing, simhash, spelling, tokenfile, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer parts than there are cores (a small table in one file), dealt over all cores."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def queries() -> dict[str, Query]:
    return {
        "op1_license_scan": lambda spark, d: licenses.op1_license_scan(spark, _documents(spark, d)),
        "op2_collision_ann": lambda spark, d: ann.op2_collision_ann(spark, spark.read.parquet(f"{d}/embeddings.parquet")),
        "op3_toxicity_gbt": lambda spark, d: toxicity.op3_toxicity_gbt(spark, _documents(spark, d), _labels(spark, d)),
        "op4_simple8b_tokens": lambda spark, d: tokenfile.op4_simple8b_tokens(spark, _documents(spark, d)),
        "op5_cotrain_quality": lambda spark, d: cotrain.op5_cotrain_quality(spark, _documents(spark, d), _labels(spark, d)),
        "op6_byte_bpe": lambda spark, d: bpe.op6_byte_bpe(spark, _documents(spark, d)),
        "op7_iblt_fingerprint": lambda spark, d: iblt.op7_iblt_fingerprint(spark, _documents(spark, d)),
        "op8_pivotal_mix": lambda spark, d: mixing.op8_pivotal_mix(spark, _documents(spark, d)),
        "op9_html_url_diff": lambda spark, d: htmldiff.op9_html_url_diff(spark, _spread(spark.read.parquet(f"{d}/pages.parquet"))),
        "op10_simhash_gray": lambda spark, d: simhash.op10_simhash_gray(spark, _documents(spark, d)),
        "op11_aho_decontamination": lambda spark, d: decontamination.op11_aho_decontamination(spark, _documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet")),
        "op12_spelling_variants": lambda spark, d: spelling.op12_spelling_variants(spark, _documents(spark, d)),
        "op13_phrase_collocations": lambda spark, d: collocations.op13_phrase_collocations(spark, _documents(spark, d)),
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_aho_decontamination": decontamination.SQL, "op13_phrase_collocations": collocations.SQL}
