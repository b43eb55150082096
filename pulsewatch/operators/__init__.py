"""DataFrame -> DataFrame operators (filters, windows, aggregates, rolling,
pairing, evaluation, ordering)."""

from . import aggregates, evaluation, filters, ordering, pairing, rolling, windows

__all__ = ["aggregates", "evaluation", "filters", "ordering", "pairing", "rolling", "windows"]
