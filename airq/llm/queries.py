"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

import corpus_pipeline
from airq.llm import bpe, language, linededup, nearest, neardup, orderhash, packing, resampling, secrets, sharding, suffixdedup, toxicity, vectorcodes

QUERIES = {
    "op1_packing": packing.query,
    "op2_orderhash": orderhash.query,
    "op3_secrets": secrets.query,
    "op4_toxicity": toxicity.query,
    "op5_neardup": neardup.query,
    "op6_nearest": nearest.query,
    "op7_language": language.query,
    "op8_sharding": sharding.query,
    "op9_linededup": linededup.query,
    "op10_bpe": bpe.query,
    "op11_vectorcodes": vectorcodes.query,
    "op12_resampling": resampling.query,
    "op13_suffixdedup": suffixdedup.query,
    "pipeline": corpus_pipeline.run,
}

SQL = {"op3_secrets": secrets.SQL, "op5_neardup": neardup.SQL, "op11_vectorcodes": vectorcodes.SQL}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
