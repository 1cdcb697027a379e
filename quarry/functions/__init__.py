"""Column-expression helpers: cleaning, tokenising, guarded statistics."""

from quarry.functions import clean, stats, text  # noqa: F401
