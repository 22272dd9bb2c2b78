"""Scans: quote files, index portfolios, file listings."""
