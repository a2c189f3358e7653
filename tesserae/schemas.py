"""Schemas of the tables that runs leave behind."""

MANIFEST = "dataset string, image_path string"
