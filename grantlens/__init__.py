"""Grant-proposal and peer-review analytics as lazy Spark DataFrames."""
