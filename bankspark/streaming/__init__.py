"""Structured Streaming: change-data merge, fraud flags, rapid-fire, roll-ups."""
