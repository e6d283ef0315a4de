"""Column functions: built-in Spark expressions only, safe under ANSI mode."""
