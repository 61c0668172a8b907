"""Micro-batch ingestion with checkpointed state."""
