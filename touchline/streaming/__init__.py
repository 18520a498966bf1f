"""The shot stream."""
