"""Structured Streaming drivers sharing the batch operators."""
