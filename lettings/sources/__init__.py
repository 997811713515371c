"""Readers and writers for the raw extracts, Silver, quarantine and run artefacts."""
