"""Registered queries of the subpackage: importing the operators fills ``QUERIES``."""

from taxaweave.llm import (  # noqa: F401
    chat_format,
    decontamination,
    html_text,
    language,
    licences,
    ngram_join,
    packing,
    periodic_runs,
    sharding,
    spotsigs,
    token_files,
    toxicity,
    whitening,
)
from taxaweave.llm.common import QUERIES

__all__ = ["QUERIES"]
