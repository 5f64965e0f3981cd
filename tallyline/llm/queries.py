"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from tallyline.llm import archive, codes, counts, digest, exact, licenses, packing, phrases, pieces, pseudonyms, quality, secrets, simhash

QUERIES = {
    "op1_warc": archive.op1_warc,
    "op2_sentencepiece": pieces.op2_sentencepiece,
    "op3_simhash_neardup": simhash.op3_simhash_neardup,
    "op4_fingerprints": digest.op4_fingerprints,
    "op5_pseudonyms": pseudonyms.op5_pseudonyms,
    "op6_exact_dedup": exact.op6_exact_dedup,
    "op7_secret_scan": secrets.op7_secret_scan,
    "op8_packing": packing.op8_packing,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_quality": quality.op10_quality,
    "op11_token_counts": counts.op11_token_counts,
    "op12_vector_codes": codes.op12_vector_codes,
    "op13_collocations": phrases.op13_collocations,
}

SQL = {
    "op1_warc": archive.OP1_SQL,
    "op6_exact_dedup": exact.OP6_SQL,
    "op12_vector_codes": codes.OP12_SQL,
    "op13_collocations": phrases.OP13_SQL,
}
