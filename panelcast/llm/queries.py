"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from panelcast.llm.alignment import op12_alignment
from panelcast.llm.chunks import op1_chunks
from panelcast.llm.countjoin import OP11_SQL, op11_count_rtree
from panelcast.llm.fmindex import OP9_SQL, op9_decontamination
from panelcast.llm.licenses import op5_licenses
from panelcast.llm.packing import op10_packing
from panelcast.llm.phrases import OP13_SQL, op13_collocations
from panelcast.llm.pii import op6_pii
from panelcast.llm.secrets import OP2_SQL, op2_secrets
from panelcast.llm.simhash import op8_simhash
from panelcast.llm.syncmers import op3_syncmers
from panelcast.llm.tokenfiles import op7_token_files
from panelcast.llm.toxicity import op4_toxicity

QUERIES = {
    "op1_chunks": op1_chunks,
    "op2_secrets": op2_secrets,
    "op3_syncmers": op3_syncmers,
    "op4_toxicity": op4_toxicity,
    "op5_licenses": op5_licenses,
    "op6_pii": op6_pii,
    "op7_token_files": op7_token_files,
    "op8_simhash": op8_simhash,
    "op9_decontamination": op9_decontamination,
    "op10_packing": op10_packing,
    "op11_count_rtree": op11_count_rtree,
    "op12_alignment": op12_alignment,
    "op13_collocations": op13_collocations,
}
ORACLES: dict[str, str] = {
    "op2_secrets": OP2_SQL,
    "op9_decontamination": OP9_SQL,
    "op11_count_rtree": OP11_SQL,
    "op13_collocations": OP13_SQL,
}
