"""Named queries over the star-schema tables, with an SQL statement for each."""
