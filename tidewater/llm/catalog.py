"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from tidewater.llm import op1_html, op2_lines, op3_chat, op4_packing, op5_substrings, op6_fingerprint, op7_quality, op8_decontaminate, op9_neardup, op10_licenses, op11_phrases, op12_blocks, op13_whitening

QUERIES = {
    "op1_html_text": op1_html.op1_html_text,
    "op2_line_dedup": op2_lines.op2_line_dedup,
    "op3_chat_format": op3_chat.op3_chat_format,
    "op4_best_fit_packing": op4_packing.op4_best_fit_packing,
    "op5_suffix_dedup": op5_substrings.op5_suffix_dedup,
    "op6_fingerprints": op6_fingerprint.op6_fingerprints,
    "op7_quality_classifier": op7_quality.op7_quality_classifier,
    "op8_decontamination": op8_decontaminate.op8_decontamination,
    "op9_near_dedup": op9_neardup.op9_near_dedup,
    "op10_license_scan": op10_licenses.op10_license_scan,
    "op11_phrase_mining": op11_phrases.op11_phrase_mining,
    "op12_block_dedup": op12_blocks.op12_block_dedup,
    "op13_whitening": op13_whitening.op13_whitening,
}

ORACLES = {
    "op2_line_dedup": op2_lines.ORACLE,
    "op3_chat_format": op3_chat.ORACLE,
    "op8_decontamination": op8_decontaminate.ORACLE,
    "op10_license_scan": op10_licenses.ORACLE,
    "op11_phrase_mining": op11_phrases.ORACLE,
}
