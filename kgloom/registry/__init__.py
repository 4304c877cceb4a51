"""The jobs applied to the given tables, and the same results in plain SQL."""

from .jobs import JOBS
from .oracles import ORACLES

__all__ = ["JOBS", "ORACLES"]
