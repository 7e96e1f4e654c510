"""Structured Streaming: the stateless risk features on arriving files."""
