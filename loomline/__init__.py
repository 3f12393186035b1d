"""loomline: line-level curation of text corpora on Spark DataFrames."""
