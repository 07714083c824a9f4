"""The operators' registered queries, each over its whole table, and SQL twins where SQL can express one."""

from __future__ import annotations

import corpus_pipeline
from lakeshift.llm import license_scan, url_automaton, warc_bundle
from lakeshift.llm.bottom_k import op6_bottomk_dedup
from lakeshift.llm.bpe import op9_bpe_roundtrip
from lakeshift.llm.decision_list import op4_quality_rules
from lakeshift.llm.hard_negatives import op12_hard_negatives
from lakeshift.llm.hilbert_ann import op1_hilbert_ann
from lakeshift.llm.license_scan import op2_license_scan
from lakeshift.llm.packing import op10_nnls_packing
from lakeshift.llm.piece_bpe import op13_piece_roundtrip
from lakeshift.llm.quote_linking import op7_quote_linking
from lakeshift.llm.sentence_spans import op3_sentence_spans
from lakeshift.llm.turn_repair import op11_turn_repair
from lakeshift.llm.url_automaton import op8_url_filter
from lakeshift.llm.warc_bundle import op5_warc_bundles

OPERATORS = (
    op1_hilbert_ann,
    op2_license_scan,
    op3_sentence_spans,
    op4_quality_rules,
    op5_warc_bundles,
    op6_bottomk_dedup,
    op7_quote_linking,
    op8_url_filter,
    op9_bpe_roundtrip,
    op10_nnls_packing,
    op11_turn_repair,
    op12_hard_negatives,
    op13_piece_roundtrip,
)
QUERIES = {f.__name__: f for f in OPERATORS} | {"pipeline": corpus_pipeline.run}

ORACLE = {
    "op2_license_scan": license_scan.ORACLE,
    "op5_warc_bundles": warc_bundle.ORACLE,
    "op8_url_filter": url_automaton.ORACLE,
}
