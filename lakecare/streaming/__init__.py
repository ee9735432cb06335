"""Structured Streaming: vitals windows, alerts and file landing."""
