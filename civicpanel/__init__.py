"""civicpanel: public-policy panel tables built as Spark plans."""

__version__ = "0.1.0"
