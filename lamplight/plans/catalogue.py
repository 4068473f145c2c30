"""The query catalogue: every query outside the llm subpackage, with its SQL."""

from __future__ import annotations

from lamplight.operators.packed import split_packed
from lamplight.plans import catalog, corpus, more, registry, retrieval, roundtrip, star
from lamplight.plans.registry import ORACLES, QUERIES, query
from lamplight.session import table


@query()
def p2_found(spark, d):
    """One row for each value of the packed cells of metadata."""
    return split_packed(table(spark, d, "metadata"), "meta_id", {"authors": "names", "subjects": "terms"}).withColumnRenamed("id", "meta_id")


__all__ = ["ORACLES", "QUERIES", "catalog", "corpus", "more", "registry", "retrieval", "roundtrip", "star"]
