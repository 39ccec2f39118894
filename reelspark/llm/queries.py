"""All queries of the operators, with their oracle SQL where there is one."""

from reelspark.llm import (  # noqa: F401
    collocations, decontamination, extraction, fingerprints, jaccard, languages, licenses, packing, personal, sharding, toxicity,
    warc, whitening,
)
from reelspark.llm.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
