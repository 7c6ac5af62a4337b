"""Named queries over the sample tables and the SQL each one has to agree with."""
