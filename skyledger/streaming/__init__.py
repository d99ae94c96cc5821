"""Structured Streaming: parse, flatten and store flight-status messages."""
