"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from .collocations import OP13_SQL, op13_collocations
from .divergence import OP12_SQL, op12_source_divergence
from .exact_dedup import OP4_SQL, op4_exact_dedup
from .language_id import op3_language_id
from .license_scan import op9_license_scan
from .mixing import OP5_SQL, op5_mixing
from .ngram_join import op1_ngram_jaccard_join
from .quality_classifier import op8_quality_classifier
from .quality_rules import OP2_SQL, op2_quality_rules
from .secret_scan import OP6_SQL, op6_secret_scan
from .sentencepiece_codec import op7_sentencepiece
from .token_counts import op10_token_counts
from .token_store import op11_token_ids

REGISTRY = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_quality_rules": op2_quality_rules,
    "op3_language_id": op3_language_id,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_mixing": op5_mixing,
    "op6_secret_scan": op6_secret_scan,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_license_scan": op9_license_scan,
    "op10_token_counts": op10_token_counts,
    "op11_token_ids": op11_token_ids,
    "op12_source_divergence": op12_source_divergence,
    "op13_collocations": op13_collocations,
}
ORACLE = {
    "op2_quality_rules": OP2_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op5_mixing": OP5_SQL,
    "op6_secret_scan": OP6_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
