"""Queries of this subpackage: name to function of (spark, sf_dir)."""

from __future__ import annotations

from .contamination import op6_contamination
from .jaccard import op10_jaccard
from .language import op9_language
from .lexical import op12_lexical
from .mixing import op5_mixing
from .neighbours import op1_neighbours
from .oracles import OP4, OP6, OP10, OP11, OP12, OP13
from .pii import op7_pii
from .quality import op3_quality
from .repeats import op4_repeats
from .runs import op11_runs
from .secrets import op8_secrets
from .topk import op13_topk
from .toxicity import op2_toxicity

QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_toxicity": op2_toxicity,
    "op3_quality": op3_quality,
    "op4_repeats": op4_repeats,
    "op5_mixing": op5_mixing,
    "op6_contamination": op6_contamination,
    "op7_pii": op7_pii,
    "op8_secrets": op8_secrets,
    "op9_language": op9_language,
    "op10_jaccard": op10_jaccard,
    "op11_runs": op11_runs,
    "op12_lexical": op12_lexical,
    "op13_topk": op13_topk,
}

ORACLES = {
    "op4_repeats": OP4,
    "op6_contamination": OP6,
    "op10_jaccard": OP10,
    "op11_runs": OP11,
    "op12_lexical": OP12,
    "op13_topk": OP13,
}
