"""Configuration, stages, run folders and variants."""
