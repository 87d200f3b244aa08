"""Review analytics on Spark: validate, translate, judge, summarize, serve, evaluate."""
