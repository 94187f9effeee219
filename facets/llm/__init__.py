"""Operators of a training-data pipeline: filtering, de-duplication, mixing,
classification and tokenisation of documents. Nothing else imports this package."""
