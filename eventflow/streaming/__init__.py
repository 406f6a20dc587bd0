"""Structured Streaming forms: stateful processors, late routing, lateness, window timers, jobs."""
