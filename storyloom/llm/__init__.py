"""Operators of a training-data pipeline: chat, near copies, toxicity, mixing, search, quality, PII, models of text."""
