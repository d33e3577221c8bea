"""Registered queries and their independent SQL."""

from __future__ import annotations


def load_all() -> None:
    """Import every area; each registers its queries.  ``jobs`` reuses SQL of the others."""
    from checks import pages, quality, cleaning, metrics, datasets, vectors, models  # noqa: F401, I001
    from checks import jobs, roundtrips, sketches  # noqa: F401
