"""Training-data operators on DataFrames of documents and pages."""
