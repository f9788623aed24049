"""Document-extraction engine on PySpark: reports in, analysable tables out."""
