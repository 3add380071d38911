"""The queries of the corpus operators and their SQL, gathered from the operators' modules."""

from __future__ import annotations

from tessera.llm import bpe, decontaminate, langid, passages, pii, quality, simhash, suffixes, urls, warc  # noqa: F401
from tessera.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
