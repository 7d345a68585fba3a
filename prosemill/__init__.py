"""Wikitext corpora on Spark: pages in, a classified, linked, deduplicated and searchable article store out."""
