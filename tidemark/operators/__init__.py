"""Retrieval, index-maintenance and analytics operators."""
