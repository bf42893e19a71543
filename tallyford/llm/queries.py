"""All queries of the subpackage."""

from . import (  # noqa: F401
    decontaminate, language_model, merkle, mixing, ngram_join, pii, quality_classifier, quality_rules, search, sharding, token_files, toxicity, warc)
from .registry import QUERIES, SQL  # noqa: F401
