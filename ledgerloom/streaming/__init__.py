"""The polled feeds as Structured Streaming jobs."""
