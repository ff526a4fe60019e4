"""The query catalogue: each query over the driver's tables, with its oracle where SQL has one."""

from . import catalogue_a, catalogue_b, catalogue_c, catalogue_d, catalogue_e, catalogue_f, catalogue_g, catalogue_h, catalogue_i, catalogue_j, catalogue_k, catalogue_l  # noqa: F401  they register
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
