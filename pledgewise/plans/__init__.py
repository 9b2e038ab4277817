"""Registered queries over the given tables, each with the same rows in DuckDB SQL where SQL can say it."""
