"""Structured Streaming bodies: table streams, versioned foreachBatch state,
keyed running state."""
