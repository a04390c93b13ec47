"""All corpus queries: importing the operators registers them."""

from __future__ import annotations

from cellar.llm import (  # noqa: F401
    collocations,
    decontaminate,
    jaccard_join,
    language,
    license_scan,
    line_dedup,
    maxent,
    packing,
    phrase_automata,
    quality,
    ranked_search,
    resharding,
    suffix_dedup,
)
from cellar.llm.registry import REGISTRY  # noqa: F401
