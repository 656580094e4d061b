"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from .fingerprints import op8_fingerprints
from .licenses import OP6_SQL, op6_licenses
from .mixing import OP5_SQL, op5_mixing
from .packing import op9_packing
from .quality import op2_quality
from .simhash import op4_simhash
from .suffixes import op1_suffix_dedup
from .tokenfile import op7_token_files
from .topk import OP3_SQL, op3_topk
from .warc import op10_warc

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality": op2_quality,
    "op3_topk": op3_topk,
    "op4_simhash": op4_simhash,
    "op5_mixing": op5_mixing,
    "op6_licenses": op6_licenses,
    "op7_token_files": op7_token_files,
    "op8_fingerprints": op8_fingerprints,
    "op9_packing": op9_packing,
    "op10_warc": op10_warc,
}

ORACLES = {
    "op3_topk": OP3_SQL,
    "op5_mixing": OP5_SQL,
    "op6_licenses": OP6_SQL,
}
