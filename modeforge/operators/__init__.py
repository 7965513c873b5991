"""Profiles, compression, mixture fit, encoders, generation and validation."""
