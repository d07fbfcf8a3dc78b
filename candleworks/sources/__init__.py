"""Landed payloads, stored layers and the ticker universe."""
