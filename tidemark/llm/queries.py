"""All queries of this package; importing it registers them."""

from tidemark.llm import alignment, fingerprints, jaccard, language, lines, mixing, packing, sharding, spans, suffixes, topk, toxicity, whitening
from tidemark.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "alignment", "fingerprints", "jaccard", "language", "lines", "mixing", "packing", "sharding", "spans", "suffixes", "topk", "toxicity", "whitening"]
