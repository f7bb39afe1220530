"""Streaming forms of scoring and monitoring, built on the batch operators."""
