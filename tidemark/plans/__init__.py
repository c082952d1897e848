"""Skew-safe building blocks: order chunks, prefix scans, lookahead."""
