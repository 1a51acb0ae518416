"""The survey dataflow: raw files to star schema, indicators and reports."""
