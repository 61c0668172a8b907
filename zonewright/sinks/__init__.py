"""Writers: Parquet, CSV, ARFF and run documents."""
