"""Banking marts on Spark: typed, clean, keyed datasets, their join, and statistics of them."""
