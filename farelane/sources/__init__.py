"""Readers and writers of trip data."""
