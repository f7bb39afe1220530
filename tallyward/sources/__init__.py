"""Reading and writing: files, tables, requests, fitted models."""
