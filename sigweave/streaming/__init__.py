"""Stateful operators and drivers for Structured Streaming."""
