"""Operations of a training-data pipeline, with their queries and SQL. Nothing outside this folder imports it."""

from tidemerge.llm import (  # noqa: F401
    ann, bpe, dialogue, fingerprints, license_scan, lm, mixing, quality, simhash, suffixes, toxicity, urls, whitening,
)
from tidemerge.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
