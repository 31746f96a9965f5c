"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""
from __future__ import annotations

from . import conversations, embeddings, jaccard, licenses, quality, search, substrings
from .conversations import op13_streamed_repair
from .decontamination import op8_decontamination
from .embeddings import op6_multi_index
from .jaccard import op4_signature_trees
from .katz import op7_katz
from .licenses import op3_license_diagonals
from .pii import op2_surrogates
from .packing import op10_best_fit
from .quality import op11_adaptive_thresholds
from .search import op12_max_sketches
from .shards import op9_byte_shards
from .substrings import op5_difference_cover
from .toxicity import op1_toxicity

QUERIES = {f.__name__: f for f in (op1_toxicity, op2_surrogates, op3_license_diagonals, op4_signature_trees, op5_difference_cover, op6_multi_index, op7_katz, op8_decontamination, op9_byte_shards, op10_best_fit, op11_adaptive_thresholds,
                                     op12_max_sketches, op13_streamed_repair)}
ORACLE: dict[str, str] = {"op3_license_diagonals": licenses.ORACLE, "op4_signature_trees": jaccard.ORACLE, "op5_difference_cover": substrings.ORACLE, "op6_multi_index": embeddings.ORACLE,
                          "op11_adaptive_thresholds": quality.ORACLE, "op12_max_sketches": search.ORACLE, "op13_streamed_repair": conversations.ORACLE}
