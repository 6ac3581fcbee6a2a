"""Validation, segmentation, continuity, universe and storage operators."""
