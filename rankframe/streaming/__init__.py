"""Continuous use of a fitted state."""

from rankframe.streaming.increments import encode_arriving_rows

__all__ = ["encode_arriving_rows"]
