"""Column functions."""

from tellerloom.functions.casts import lenient_cast
from tellerloom.functions.keys import hash_key, with_hash_key, with_validity

__all__ = ["hash_key", "lenient_cast", "with_hash_key", "with_validity"]
