"""Spark operators for measurement tables of the form entity x time slot x measure."""

from dayshape.spec import Spec, Split

__all__ = ["Spec", "Split"]
