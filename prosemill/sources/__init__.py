"""Readers that give (page_id, part, title, raw) tables."""
