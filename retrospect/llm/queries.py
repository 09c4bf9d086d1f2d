"""The queries of the operators in this folder, and their SQL where there is one."""

from __future__ import annotations

from . import bpe, exact_dedup, imatch, language, licences, negatives, packing, quality, runs, secrets, sharding, simhash, toxicity

QUERIES = {
    "op1_packing": packing.op1,
    "op2_secrets": secrets.op2,
    "op3_bpe": bpe.op3,
    "op4_language": language.op4,
    "op5_quality": quality.op5,
    "op6_simhash": simhash.op6,
    "op7_sharding": sharding.op7,
    "op8_imatch": imatch.op8,
    "op9_licences": licences.op9,
    "op10_exact_dedup": exact_dedup.op10,
    "op11_toxicity": toxicity.op11,
    "op12_hard_negatives": negatives.op12,
    "op13_runs": runs.op13,
}
SQL = {"op10_exact_dedup": exact_dedup.SQL, "op12_hard_negatives": negatives.SQL}
