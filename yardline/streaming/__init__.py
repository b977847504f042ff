"""Structured Streaming: landing, running sums, redelivery."""
