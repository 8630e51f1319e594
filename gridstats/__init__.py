"""gridstats: play-by-play football analytics as Spark DataFrame plans."""
