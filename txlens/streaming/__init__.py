"""Structured Streaming: codec, stateful features, warm start and scoring."""
