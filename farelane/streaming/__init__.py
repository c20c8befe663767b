"""Request validation and streaming scoring."""
