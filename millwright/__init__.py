"""Industrial analytics on Spark DataFrames: medallion loads, OEE reporting,
data-quality audits, ordered gap filling and predictive maintenance."""
