"""txlens: payment-risk analytics as plain Spark DataFrame functions."""
