"""Receivables and revenue marts from accounting documents, as Spark DataFrame plans."""
