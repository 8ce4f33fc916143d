"""Readers, writers, stage cache, model registry and run log."""
