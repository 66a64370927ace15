"""Readers: catalog tables and SQL, inline rows, binary files, JSON documents, JDBC."""
