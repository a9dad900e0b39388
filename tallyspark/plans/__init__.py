"""Query plans: stand-in fixtures and the registry of queries with their oracle SQL."""

from tallyspark.plans.fixtures import FIXTURE_SQL, fixture, oracle_ctes, prepare, typed_fixture
from tallyspark.plans.registry import REGISTRY, oracle_sql, queries

__all__ = ["FIXTURE_SQL", "REGISTRY", "fixture", "oracle_ctes", "oracle_sql", "prepare", "queries", "typed_fixture"]
