"""Readers and writers for landed files and warehouse tables."""
