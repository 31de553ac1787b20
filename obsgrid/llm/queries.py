"""All queries of this subpackage."""

from obsgrid.llm import (  # noqa: F401
    bpe,
    cuckoo,
    html_text,
    langid,
    lattice,
    licenses,
    mixing,
    packing,
    periods,
    simhash,
    spelling,
    toxicity,
    warc,
)
from obsgrid.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
