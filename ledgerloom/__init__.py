"""ledgerloom: securities listings, filings and fundamentals as Spark DataFrames."""
