"""Queries of the corpus operators and their DuckDB texts."""

from __future__ import annotations

from tabsmith.llm.bpe import op6_byte_bpe
from tabsmith.llm.conv_repair import ORACLE_SQL as REPAIR_SQL
from tabsmith.llm.conv_repair import op12_conversation_repair
from tabsmith.llm.decontam import op3_decontamination
from tabsmith.llm.embed_dedup import op5_ego_join
from tabsmith.llm.lang_id import op8_language_id
from tabsmith.llm.line_dedup import ORACLE_SQL as LINE_SQL
from tabsmith.llm.line_dedup import op11_line_dedup
from tabsmith.llm.periodic_runs import ORACLE_SQL as RUNS_SQL
from tabsmith.llm.periodic_runs import op13_periodic_runs
from tabsmith.llm.pii import op7_pii
from tabsmith.llm.quality_crf import op9_quality_crf
from tabsmith.llm.secret_scan import op2_secret_scan
from tabsmith.llm.simhash import op1_simhash
from tabsmith.llm.suffix_dedup import op10_suffix_array
from tabsmith.llm.warc import ORACLE_SQL as WARC_SQL
from tabsmith.llm.warc import op4_warc_index

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontamination": op3_decontamination,
    "op4_warc_index": op4_warc_index,
    "op5_ego_join": op5_ego_join,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_pii": op7_pii,
    "op8_language_id": op8_language_id,
    "op9_quality_crf": op9_quality_crf,
    "op10_suffix_array": op10_suffix_array,
    "op11_line_dedup": op11_line_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE = {
    "op4_warc_index": WARC_SQL,
    "op11_line_dedup": LINE_SQL,
    "op12_conversation_repair": REPAIR_SQL,
    "op13_periodic_runs": RUNS_SQL,
}
