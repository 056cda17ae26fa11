"""DuckDB SQL that states, independently of Spark, what each registered query must return."""
