"""Transit-delay analytics and decision support as Spark DataFrame operators."""
