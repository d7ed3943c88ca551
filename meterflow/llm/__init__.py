"""Operators of a training-data pipeline, one module each; nothing else here imports them."""
