"""Operators over the queue, the catalogue, user tables and the outbox."""
