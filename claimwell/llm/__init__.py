"""Operators for preparing training text, and their queries. Nothing else imports this package."""
