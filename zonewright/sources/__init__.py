"""Readers for dirty name lists and accepted-name relations."""
