"""Models, marts and the questions asked of them."""

from . import marts, models, queries

__all__ = ["marts", "models", "queries"]
