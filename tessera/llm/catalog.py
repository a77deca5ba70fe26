"""All queries of the training-data operators, registered by importing their modules."""

from tessera.llm import (align, bestfit, decontaminate, lines, merkle, minhash, packing, pii, quality, quotes, tokens,  # noqa: F401
                         urllists, warc)
from tessera.llm.common import ORACLES, QUERIES


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)
