"""Queries of this subpackage, and their SQL where it has a form."""

from __future__ import annotations

from . import decontaminate, langid, licences, minhash, pieces, ppm, quality, repeats, tokenstore, warc


def _pipeline(spark, sf_dir: str):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_quality_rules": quality.query,
    "op2_lm_scoring": ppm.query,
    "op3_token_output": tokenstore.query,
    "op4_benchmark_decontamination": decontaminate.query,
    "op5_sentencepiece": pieces.query,
    "op6_suffix_array_dedup": repeats.query,
    "op7_warc": warc.query,
    "op8_language_id": langid.query,
    "op9_minhash_near_dedup": minhash.query,
    "op10_license_scans": licences.query,
    "pipeline": _pipeline,
}

SQL = {
    "op1_quality_rules": quality.SQL,
    "op4_benchmark_decontamination": decontaminate.SQL,
    "op6_suffix_array_dedup": repeats.SQL,
    "op7_warc": warc.SQL,
    "op9_minhash_near_dedup": minhash.SQL,
}
