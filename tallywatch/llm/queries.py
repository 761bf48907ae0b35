"""The corpus queries, named after their operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywatch.llm.alignment import op13_alignment
from tallywatch.llm.bpe import op3_bpe
from tallywatch.llm.decontaminate import ORACLE as DECONTAMINATE_SQL
from tallywatch.llm.decontaminate import op11_decontaminate
from tallywatch.llm.html_text import op6_html
from tallywatch.llm.infill import ORACLE as INFILL_SQL
from tallywatch.llm.infill import op12_infill
from tallywatch.llm.lm import op4_lm
from tallywatch.llm.neardup import op5_neardup
from tallywatch.llm.packing import op7_packing
from tallywatch.llm.quality import op8_quality
from tallywatch.llm.repeats import op9_repeats
from tallywatch.llm.secret_scan import op2_secrets
from tallywatch.llm.topk import ORACLE as TOPK_SQL
from tallywatch.llm.topk import op10_topk
from tallywatch.llm.toxicity import op1_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_secrets": op2_secrets,
    "op3_bpe": op3_bpe,
    "op4_lm": op4_lm,
    "op5_neardup": op5_neardup,
    "op6_html": op6_html,
    "op7_packing": op7_packing,
    "op8_quality": op8_quality,
    "op9_repeats": op9_repeats,
    "op10_topk": op10_topk,
    "op11_decontaminate": op11_decontaminate,
    "op12_infill": op12_infill,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {
    "op10_topk": TOPK_SQL,
    "op11_decontaminate": DECONTAMINATE_SQL,
    "op12_infill": INFILL_SQL,
}
