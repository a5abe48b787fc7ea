"""Operators of a training-data pipeline: selection, near copies, personal data, mixing, tokens, search, chat."""
