from cartsight.plans.oracle import ORACLES
from cartsight.plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
