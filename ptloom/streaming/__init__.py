"""Structured Streaming entry points (the record validators are stateless projections)."""
