"""Operators: generic vault loaders, the incremental anti-join, vault storage, audits."""
