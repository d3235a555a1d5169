"""Structured Streaming counterparts of the batch ledger folds."""
