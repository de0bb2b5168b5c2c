"""tally: counted results that arrive as successive snapshots, analysed with Spark."""
