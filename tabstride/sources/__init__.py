"""Readers and writers, grouped by module: tables, pages, artefacts."""
