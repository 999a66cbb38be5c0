"""Inputs and outputs: files, schemas, seeds, stored pages and views over given tables."""
