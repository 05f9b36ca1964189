"""Production parameters that a query and its SQL share."""

from __future__ import annotations

# The hot source counts double; the other named ones, and all others together, weigh the same.
SOURCE_WEIGHTS = {"src0": 2.0} | {f"src{i}": 1.0 for i in range(1, 20)}
