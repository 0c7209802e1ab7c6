"""Operators that prepare training text at scale; nothing else in seqloom imports them."""
