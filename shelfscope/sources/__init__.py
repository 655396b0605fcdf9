"""Readers. All take explicit schemas or read raw lines."""
