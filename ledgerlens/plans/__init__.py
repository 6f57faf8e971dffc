"""The catalogue of analyses, reports and batch runs."""
