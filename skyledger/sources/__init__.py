"""Readers: landed JSON documents and raw tables."""
