"""Schemas, readers, writers and the versioned ratings store."""
