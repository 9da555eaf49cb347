"""Streams: growing folders of JSON lines, resumption by key, groups that are complete."""
