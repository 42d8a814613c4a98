"""Table work around language-model alignment, written as Spark DataFrame operators."""
