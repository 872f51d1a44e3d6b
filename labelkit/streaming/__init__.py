"""Structured Streaming: decode, clean, score and encode message streams."""
