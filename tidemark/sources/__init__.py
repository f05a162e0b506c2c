"""Readers for event streams, event files, external tables and model artifacts."""
