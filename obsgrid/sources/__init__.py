"""Readers, writers and the observation-shaped views."""
