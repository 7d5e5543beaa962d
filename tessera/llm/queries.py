"""The registered queries of the training-data operators."""

from __future__ import annotations

from tessera.llm.bpe import op4_byte_bpe
from tessera.llm.chat import op1_chat_format
from tessera.llm.divergence import op12_source_divergence
from tessera.llm.kdtree import op6_kdtree_topk
from tessera.llm.licenses import op10_license_scan
from tessera.llm.minhash import op5_minhash_dedup
from tessera.llm.mixing import op8_pareto_mixing
from tessera.llm.oracles import ORACLES
from tessera.llm.periodic import op13_periodic_runs
from tessera.llm.quality import op3_quality
from tessera.llm.quantised import op9_additive_quantisation
from tessera.llm.secrets import op11_secret_scan
from tessera.llm.suffixes import op2_suffix_dedup
from tessera.llm.urls import op7_url_filter

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    q.__name__: q
    for q in (
        op1_chat_format,
        op2_suffix_dedup,
        op3_quality,
        op4_byte_bpe,
        op5_minhash_dedup,
        op6_kdtree_topk,
        op7_url_filter,
        op8_pareto_mixing,
        op9_additive_quantisation,
        op10_license_scan,
        op11_secret_scan,
        op12_source_divergence,
        op13_periodic_runs,
    )
}
