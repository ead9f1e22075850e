"""folio: page-level Markdown benchmark building and scoring on Spark DataFrames."""

from folio.params import Params

__all__ = ["Params"]
