"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chat, chunks, decontam, lines, lm, media, mixing, neardup, suffix, toxicity

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_lines": lines.op2_lines,
    "op3_lm": lm.op3_lm,
    "op4_mix": mixing.op4_mix,
    "op5_chunks": chunks.op5_chunks,
    "op6_decontaminate": decontam.op6_decontaminate,
    "op7_suffix": suffix.op7_suffix,
    "op8_media": media.op8_media,
    "op9_neardup": neardup.op9_neardup,
    "op10_preferences": chat.op10_preferences,
}
SQL = {"op2_lines": lines.SQL, "op4_mix": mixing.SQL, "op6_decontaminate": decontam.SQL, "op10_preferences": chat.SQL}
