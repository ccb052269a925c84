"""Batch operators: normalisation, idempotent load + watermark, data tests."""

from . import load, normalize, quality

__all__ = ["load", "normalize", "quality"]
