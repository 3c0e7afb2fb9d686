"""Readers of dataset directories and writers of published tables."""
