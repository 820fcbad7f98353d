"""Readers, payload normalisers and sinks."""
