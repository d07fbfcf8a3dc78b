"""Streams of landed bars and ticks."""
