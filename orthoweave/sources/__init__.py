"""Readers and writers: video listings, images, world files, CSV, stage tables."""
