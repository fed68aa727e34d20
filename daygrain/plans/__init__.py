"""The analyses on the three raw data sets, composed from the operators."""

from daygrain.plans import collisions, impact, ridership, weather
from daygrain.plans.run import Scope, run

__all__ = ["collisions", "impact", "ridership", "Scope", "run", "weather"]
