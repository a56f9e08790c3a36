"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from cairnspark.llm import decontam, langid, licenses, line_dedup, minhash, mixing, suffixes, toxicity, vectors, warc

QUERIES = {
    "op1_decontaminate": decontam.op1,
    "op2_suffix_dedup": suffixes.op2,
    "op3_license_scan": licenses.op3,
    "op4_language_id": langid.op4,
    "op5_toxicity": toxicity.op5,
    "op6_minhash": minhash.op6,
    "op7_warc": warc.op7,
    "op8_embedding_dedup": vectors.op8,
    "op9_line_dedup": line_dedup.op9,
    "op10_mix_sources": mixing.op10,
}

ORACLES = {
    "op2_suffix_dedup": suffixes.OP2_SQL,
    "op3_license_scan": licenses.OP3_SQL,
    "op6_minhash": minhash.OP6_SQL,
    "op7_warc": warc.OP7_SQL,
    "op8_embedding_dedup": vectors.OP8_SQL,
    "op9_line_dedup": line_dedup.OP9_SQL,
}
