from panelspark.queries import air, codes, files, gdp, people, published  # noqa: F401  (registers the queries)
from panelspark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
