"""Structured Streaming forms of the stateless operators and a windowed reward metric."""
