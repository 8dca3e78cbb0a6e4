"""Structured Streaming: sources, the streaming detector, sinks and the round driver."""
