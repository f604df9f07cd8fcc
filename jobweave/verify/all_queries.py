"""Importing this module registers every query."""

from jobweave.verify import columns, joins, models, raw  # noqa: F401, I001
from jobweave.verify import model_checks, updates  # noqa: F401  (take their SQL from models)
