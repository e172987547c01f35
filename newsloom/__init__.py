"""newsloom: news-feed documents in, ranked topics out, as Spark DataFrames."""
