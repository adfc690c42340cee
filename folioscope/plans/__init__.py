"""The registered queries and the SQL each of them must agree with."""

from folioscope.plans import (  # noqa: F401  (importing a module registers its queries)
    conversation_plans,
    crawl_plans,
    document_plans,
    name_plans,
    table_plans,
    text_plans,
    vector_plans,
)
from folioscope.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
