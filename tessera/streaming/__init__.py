"""Structured Streaming adapters.

The reference has no streaming operators (no watermarks, event-time
windows or stateful operators), so nothing here adds stream semantics of
its own: ``microbatch`` runs the library's batch operators over each
micro-batch of a file stream with exactly-once, checkpointed progress.
"""
