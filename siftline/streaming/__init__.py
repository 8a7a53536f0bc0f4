"""Streams and what they become in batches: webhooks, the queue, feeds, suppression, sequences."""
