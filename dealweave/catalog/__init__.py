"""All registered queries; importing this package fills the registry."""

from . import audit_q, company_q, extract_q, funding_q, keyed_q, lookup_q, plan_q, rank_q, resolve_q, source_q, stored_q  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
