"""All registered queries (import side effect fills the registry)."""

from tableprep.registry import q_clean, q_dedup, q_fit, q_stats  # noqa: F401
from tableprep.registry.base import ORACLES, QUERIES

__all__ = ['QUERIES', 'ORACLES']
