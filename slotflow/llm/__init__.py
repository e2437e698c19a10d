"""Preparation of text for training: tokens, language, quality, duplicates, personal data, archives, shards."""
