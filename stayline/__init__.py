"""stayline - subscriber retention analytics as plain Spark DataFrame functions."""
