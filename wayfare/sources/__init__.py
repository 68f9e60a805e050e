"""Readers and writers, and the ride-hailing inputs derived from the star-schema tables."""
