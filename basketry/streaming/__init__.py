"""Structured Streaming: ad-hoc basket scoring against fitted rule tables."""
