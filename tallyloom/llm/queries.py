"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.chat_format import OP3_SQL, op3_chat_formatting
from tallyloom.llm.decontamination import op1_decontamination
from tallyloom.llm.language_id import op7_language_id
from tallyloom.llm.license_scan import op4_license_scan
from tallyloom.llm.line_dedup import OP8_SQL, op8_line_dedup
from tallyloom.llm.near_dedup import OP10_SQL, op10_near_dedup
from tallyloom.llm.piece_lattice import op6_sentencepiece
from tallyloom.llm.quality_rules import op2_quality_rules
from tallyloom.llm.substring_dedup import OP9_SQL, op9_substring_dedup
from tallyloom.llm.token_files import op5_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op10_near_dedup": op10_near_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_license_scan": op4_license_scan,
    "op5_token_files": op5_token_files,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_language_id": op7_language_id,
    "op8_line_dedup": op8_line_dedup,
    "op9_substring_dedup": op9_substring_dedup,
}

SQL: dict[str, str] = {"op3_chat_formatting": OP3_SQL, "op8_line_dedup": OP8_SQL, "op9_substring_dedup": OP9_SQL, "op10_near_dedup": OP10_SQL}
