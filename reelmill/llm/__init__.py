"""Operators for preparing training text: de-duplication, filtering, search, mixing and storage of token ids."""
