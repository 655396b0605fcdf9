"""Operators over text, embedding and page tables for training data, and their queries."""
