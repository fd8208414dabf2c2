"""Intermediate tables of the corpus operators (see :mod:`sporelight.store`)."""

from ..store import discard, shared_folder, written

__all__ = ["discard", "shared_folder", "written"]
