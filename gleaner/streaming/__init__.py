"""Structured Streaming front ends of the per-document stages."""
