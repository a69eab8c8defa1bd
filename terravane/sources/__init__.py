"""Readers and writers: XML, Parquet, archives, schema files and the shared work folder."""
