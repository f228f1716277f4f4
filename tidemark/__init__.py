"""tidemark: product, ledger and finance analytics plus data-quality checks on Spark DataFrames."""
