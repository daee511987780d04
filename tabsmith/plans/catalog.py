"""All registered queries: importing the catalogue modules fills the registry."""

from tabsmith.plans import q_checks, q_clean, q_dates, q_drift, q_encode, q_models, q_profile, q_tables  # noqa: F401
from tabsmith.plans.registry import ORACLE, QUERIES  # noqa: F401
