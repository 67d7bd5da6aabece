"""Operators that turn raw documents and conversations into training data."""
