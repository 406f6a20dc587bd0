"""Registered queries: importing this package fills the registry."""

from eventflow.plans import graphs, readback, texts, timed, windowed  # noqa: F401
