"""Operators of a training-data pipeline: chats, duplicates, secrets, leaks, licences, languages, mixtures."""
