"""Operators of a training-data pipeline (documents in, cleaned and tokenised data out).

Nothing outside this subpackage imports it; ``register`` hands its queries to the entry
file."""
