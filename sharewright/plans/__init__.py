"""Conforming plan of each dataset. A plan returns a `Conformed`: rows, removed rows, trail and rule log."""
from .conformed import Conformed

__all__ = ["Conformed"]
