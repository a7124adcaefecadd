"""checkmart: point-of-sale check analytics written as PySpark DataFrame operators."""
