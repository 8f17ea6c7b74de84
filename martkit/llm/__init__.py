"""Operators for large text corpora.  Nothing else in the library imports this."""

from __future__ import annotations

import importlib

import pyspark.cloudpickle as cloudpickle

# Functions of this subpackage travel to the executors with the job, so a
# cluster needs no copy of the package on its workers' path.
cloudpickle.register_pickle_by_value(importlib.import_module(__name__))

MODULES = ["quality", "packing", "decontaminate", "warc", "toxicity", "line_dedup", "jaccard_join", "licenses", "ppm", "suffix_dedup", "merkle", "lexical", "secrets"]


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out.update(getattr(importlib.import_module(f"{__name__}.{name}"), attribute))
    return out


QUERIES = _merged("QUERIES")
ORACLES = _merged("ORACLE_SQL")
