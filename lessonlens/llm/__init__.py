"""Operators for preparing training text: near-duplicates, decontamination, licences,
language, quality, exact repeats, chat logs, perplexity rules, personal data, tokens.

Nothing outside this subpackage imports it; ``registry`` holds its queries.
"""
