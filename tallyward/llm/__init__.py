"""Operators for large training corpora: deduplication, joins, privacy, chat, quality, archives."""
