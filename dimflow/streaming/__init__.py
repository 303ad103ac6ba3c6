"""Incremental reading of landing folders."""
