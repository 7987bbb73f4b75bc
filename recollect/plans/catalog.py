"""Every query of the engine and its SQL, by name."""

from __future__ import annotations

from recollect.plans import q_eval, q_filters, q_jobs, q_misc, q_retrieval, q_store  # noqa: F401  they register their queries
from recollect.plans.base import ORACLES, QUERIES

FLAGSHIP = QUERIES["knn_scoped_filtered"]

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
