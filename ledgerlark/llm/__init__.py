"""Operators for building training data from documents; nothing else imports them."""
