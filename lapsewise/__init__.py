"""Payment-risk analytics on Spark: billing history in, risk decisions out."""
