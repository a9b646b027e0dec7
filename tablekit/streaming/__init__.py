"""Structured Streaming: incremental file ingest (each file loaded once,
checkpointed) and stateful stream aggregates (windowed / running counts)."""
