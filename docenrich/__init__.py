"""A PySpark engine that enriches document collections through a model."""
