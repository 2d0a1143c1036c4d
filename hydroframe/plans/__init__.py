"""Registered queries; importing this package registers all of them."""

from . import derived, filters, grouped, joins, scalars, sections, stats, streams, tables, windows  # noqa: F401
