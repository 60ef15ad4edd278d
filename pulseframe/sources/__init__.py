"""Readers and writers: clinical files, message topics, tracks, points, tables."""
