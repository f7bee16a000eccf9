"""Incremental tables for publications that keep arriving."""
