"""Registered queries, one module per operator family (imported for their
registration side effect)."""

from . import io, prep, relate, agg, window, scalar, arrays, encode, flows, models  # noqa: F401
