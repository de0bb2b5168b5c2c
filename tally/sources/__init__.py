"""Reading feeds and tables, writing results."""
