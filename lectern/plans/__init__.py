"""The six stages, from media files to an annotated corpus."""
