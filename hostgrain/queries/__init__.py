"""Named queries over the star-schema tables, and DuckDB SQL with the same results."""
