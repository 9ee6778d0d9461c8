"""Micro-batch forms of the keyed merge and of statement deduplication."""
