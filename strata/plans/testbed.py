"""Imports every testbed module so that the registry is complete."""

from strata.plans import (  # noqa: F401
    testbed_checks, testbed_cohort, testbed_features, testbed_ml, testbed_models, testbed_overlap, testbed_passenger,
    testbed_profile, testbed_sources,
)
from strata.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
