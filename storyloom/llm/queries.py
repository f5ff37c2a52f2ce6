"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from storyloom.llm.alignment import op13_token_alignment
from storyloom.llm.chat import op9_quotation_links
from storyloom.llm.chat import oracle as quotation_oracle
from storyloom.llm.fingerprint import op6_fingerprints
from storyloom.llm.license_scan import op1_license_scan
from storyloom.llm.license_scan import oracle as license_oracle
from storyloom.llm.neardup import op3_near_duplicates
from storyloom.llm.neardup import oracle as near_duplicate_oracle
from storyloom.llm.packing import op8_best_two_fit
from storyloom.llm.quality import op4_quality_rules
from storyloom.llm.repair import op12_structure_repair
from storyloom.llm.repair import oracle as repair_oracle
from storyloom.llm.secret_scan import op7_secret_spans
from storyloom.llm.secret_scan import oracle as secret_oracle
from storyloom.llm.token_store import op5_token_store
from storyloom.llm.toxicity import op10_toxic_segments
from storyloom.llm.warc import op11_web_archives
from storyloom.llm.warc import oracle as archive_oracle
from storyloom.llm.wfst import op2_sentencepiece

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_store": op5_token_store,
    "op6_fingerprints": op6_fingerprints,
    "op7_secret_spans": op7_secret_spans,
    "op8_best_two_fit": op8_best_two_fit,
    "op9_quotation_links": op9_quotation_links,
    "op10_toxic_segments": op10_toxic_segments,
    "op11_web_archives": op11_web_archives,
    "op12_structure_repair": op12_structure_repair,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op1_license_scan": license_oracle(),
    "op3_near_duplicates": near_duplicate_oracle(),
    "op7_secret_spans": secret_oracle(),
    "op9_quotation_links": quotation_oracle(),
    "op11_web_archives": archive_oracle(),
    "op12_structure_repair": repair_oracle(),
}
