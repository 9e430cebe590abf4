"""Column expressions; none of them needs a UDF."""
