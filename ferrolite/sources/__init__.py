"""Readers and writers of structures, runs and tables, on any file system that Spark reads."""
