"""tallystone: a rollup-cube analytics engine on Spark DataFrames."""
