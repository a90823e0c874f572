"""reviewflow: DataFrame operators for product-review and order events."""

__version__ = "0.1.0"
