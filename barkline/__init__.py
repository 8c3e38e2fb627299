"""Molecular-barcode analytics on Spark."""
