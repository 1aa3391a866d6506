"""The corpus queries and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

from wagerscope.llm import audit, language, minhash, mixing, periodic, pieces, quality, secrets, simhash, tokenfile, vectors, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_language": language.op2_language,
    "op3_secrets": secrets.op3_secrets,
    "op4_token_counts": pieces.op4_token_counts,
    "op5_simhash": simhash.op5_simhash,
    "op6_token_orc": tokenfile.op6_token_orc,
    "op7_sentencepiece": pieces.op7_sentencepiece,
    "op8_one_bit_codes": vectors.op8_one_bit_codes,
    "op9_quality": quality.op9_quality,
    "op10_mixing": mixing.op10_mixing,
    "op11_filter_audit": audit.op11_filter_audit,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_minhash": minhash.op13_minhash,
}

ORACLE: dict[str, str] = {
    "op1_warc": warc.OP1_SQL,
    "op8_one_bit_codes": vectors.OP8_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_filter_audit": audit.OP11_SQL,
}
