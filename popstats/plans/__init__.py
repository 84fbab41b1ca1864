
from popstats.plans import queries as _queries  # noqa: F401  (registers the queries)
from popstats.plans.registry import oracles, queries

__all__ = ["queries", "oracles"]
