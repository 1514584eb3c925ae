"""Registered queries of the text operators."""

from __future__ import annotations

from linkmill.llm import oracles
from linkmill.llm.audio import op4_audio
from linkmill.llm.decontaminate import op10_decontamination
from linkmill.llm.jaccard_join import op9_jaccard_join
from linkmill.llm.licenses import op6_license_scan
from linkmill.llm.packing import op8_packing
from linkmill.llm.quality import op5_quality
from linkmill.llm.secret_scan import op7_secret_scan
from linkmill.llm.sharding import op2_sharding
from linkmill.llm.token_counts import op3_token_counts
from linkmill.llm.toxicity import op1_toxicity


def queries() -> dict:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_sharding": op2_sharding,
        "op3_token_counts": op3_token_counts,
        "op4_audio": op4_audio,
        "op5_quality": op5_quality,
        "op6_license_scan": op6_license_scan,
        "op7_secret_scan": op7_secret_scan,
        "op8_packing": op8_packing,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_decontamination": op10_decontamination,
    }


def oracle_sql() -> dict:
    """The others are tested against brute force: their rows depend on vocabularies, trained models or automata."""
    return {"op7_secret_scan": oracles.SECRETS, "op9_jaccard_join": oracles.JACCARD, "op10_decontamination": oracles.DECONTAMINATION}
