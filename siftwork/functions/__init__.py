"""Scalar functions: Column expressions, and Arrow functions where Catalyst has none."""
