"""Registered queries of the corpus operators and the SQL that states them."""

from __future__ import annotations

from sentiflow.llm import centroids, decontamination, divergence, hmm, language_id, licenses, mixing, near_dedup, neighbours, pii, suffix_dedup, url_filter, warc

QUERIES = {
    "op1_hidden_markov_lm": hmm.op1_hidden_markov_lm,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_pii": pii.op3_pii,
    "op4_language_id": language_id.op4_language_id,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_learned_partitions": neighbours.op7_learned_partitions,
    "op8_bagminhash": near_dedup.op8_bagminhash,
    "op9_temperature_mixing": mixing.op9_temperature_mixing,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_ns_bounds": centroids.op11_ns_bounds,
    "op12_warc": warc.op12_warc,
    "op13_divergence": divergence.op13_divergence,
}
ORACLE = {
    "op2_decontamination": decontamination.ORACLE_SQL,
    "op5_url_filter": url_filter.ORACLE_SQL,
    "op11_ns_bounds": centroids.ORACLE_SQL,
    "op12_warc": warc.ORACLE_SQL,
    "op13_divergence": divergence.ORACLE_SQL,
}
