"""Structured Streaming jobs. None of them sets a watermark: late posts are never dropped."""
